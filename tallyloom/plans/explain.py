"""What Spark is going to do, as rows."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

from tallyloom.session import scoped

_SCHEMA = (
    "operator int, node string, partition_filters string, pushed_filters string, "
    "read_schema string, dealt_by string"
)


def plan_rows(df: DataFrame) -> DataFrame:
    """(operator, node, partition_filters, pushed_filters, read_schema, dealt_by), a row per operator.

    Filters and schema are those of a scan, dealt_by is how an exchange spreads its rows; null for
    other operators. Ids of expressions are left out, so equal plans give equal rows.
    """
    spark = df.sparkSession
    with scoped(spark, {"spark.sql.maxMetadataStringLength": 1 << 20}):
        said = io.StringIO()
        with contextlib.redirect_stdout(said):
            df.explain("formatted")
    text = re.sub(r"#x?[0-9]+L?", "", said.getvalue())
    rows = []
    for head, body in re.findall(r"^\((\d+\) [^\n]*)\n((?:(?!\(\d+\) )[^\n]+\n?)*)", text, re.MULTILINE):
        number, _, node = head.partition(") ")
        node = re.sub(r" *\[codegen id : \d+\]", "", node).strip()
        said = dict(re.findall(r"^(\w+): (.*)$", body, re.MULTILINE))
        dealt = said.get("Arguments") if node.endswith("Exchange") else None
        none = "[]" if node.startswith("Scan") else None
        filters = (said.get(name, none) for name in ("PartitionFilters", "PushedFilters"))
        rows.append((int(number), node, *filters, said.get("ReadSchema"), dealt))
    return spark.createDataFrame(rows, _SCHEMA)
