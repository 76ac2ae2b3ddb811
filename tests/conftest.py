import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


# Thirty worksheet rows in our own wording: five categories of six
# questions each, two question types (fifteen of each).
CATEGORIES = ["billing", "storage", "compute", "network", "security"]
TOPICS = {
    "billing": ["invoice totals", "credit refunds", "monthly budget alerts", "tax on receipts",
                "payment card updates", "usage charges"],
    "storage": ["bucket versioning", "object lifecycle rules", "archive retrieval time", "upload size limits",
                "replication across regions", "encryption at rest"],
    "compute": ["instance sizing", "auto scaling groups", "spot capacity", "boot volume growth",
                "instance metadata", "scheduled restarts"],
    "network": ["private subnets", "load balancer health checks", "dns failover", "peering between networks",
                "egress costs", "firewall rule limits"],
    "security": ["key rotation", "access policies", "multi factor login", "audit trails",
                 "secret storage", "role assumption"],
}


def sheet_rows():
    rows = []
    serial = 0
    for cat in CATEGORIES:
        for j, topic in enumerate(TOPICS[cat]):
            qtype = "how-to" if j % 2 == 0 else "troubleshooting"
            verb = "How do I configure" if qtype == "how-to" else "Why does my setup fail with"
            rows.append((cat, serial, f"{verb} {topic}?", qtype))
            serial += 1
    return rows


@pytest.fixture(scope="session")
def sheet_df(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(sheet_rows(), "category string, category_serial_number bigint, "
                                             "sample_question string, sample_question_type string")
    return df.select(F.lit("support").alias("workbook"), F.lit("Questions").alias("sheet"),
                     F.col("category_serial_number").alias("row_idx"), "*")
