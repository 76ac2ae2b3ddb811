"""Canonical column names shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T

# A corpus is one long DataFrame keyed by these columns.
WORKBOOK = "workbook"
SHEET = "sheet"
ROW_IDX = "row_idx"
CELLS = "cells"
SPLIT = "split"
GROUP: list[str] = [WORKBOOK, SHEET]

TRAIN = "train"
TEST = "test"

# Raw form produced by the xlsx source: one row per worksheet row.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(WORKBOOK, T.StringType(), False),
        T.StructField(SHEET, T.StringType(), False),
        T.StructField(ROW_IDX, T.LongType(), False),
        T.StructField(CELLS, T.MapType(T.StringType(), T.StringType()), True),
    ]
)

# The default worksheet columns and their types
# (category, category_serial_number, sample_question, sample_question_type).
DEFAULT_SHEET_SCHEMA = T.StructType(
    [
        T.StructField("category", T.StringType(), True),
        T.StructField("category_serial_number", T.LongType(), True),
        T.StructField("sample_question", T.StringType(), True),
        T.StructField("sample_question_type", T.StringType(), True),
    ]
)
DEFAULT_TEXT_COLS = ["sample_question", "sample_question_type"]
DEFAULT_LABEL_COLS = ["category"]


def group_cols(by: list[str] | None) -> list[str]:
    return list(GROUP if by is None else by)
