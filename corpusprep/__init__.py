"""corpusprep: labelled text corpus preparation on Spark.

Every operator takes and returns DataFrames. The unit of work is a *group*
(by default the columns ``workbook`` and ``sheet``); operators run for all
groups in one Spark job with the group columns as keys.
"""

from corpusprep.schema import GROUP

__all__ = ["GROUP"]
