"""Extra columns with awkward names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from samples import prose

from fairdraw.llm import decontaminate, lines, minhash, mixing

OPERATORS = {
    "lines": lambda docs, benchmark: lines.deduplicated(docs),
    "mixing": lambda docs, benchmark: mixing.mixed(docs, mixing.Mix("'one'", budget_permille=1000)),
    "minhash": lambda docs, benchmark: minhash.deduplicated(docs),
    "decontaminate": decontaminate.clean,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_dots_cases_and_reserved_names(spark, documents, name):
    docs = documents([(i, prose(i, 20)) for i in range(6)]).withColumns({"a.b": F.lit(1), "N_Lines": F.lit(2), "x`y": F.lit(3)})
    docs = docs.withColumnRenamed("copies", "Copies")
    benchmark = spark.createDataFrame([(1, prose(99, 20))], "item_id long, text string")
    got = OPERATORS[name](docs, benchmark)
    assert {"a.b", "x`y"} <= set(got.columns) and len({c.lower() for c in got.columns}) == len(got.columns)
    rows = got.collect()
    assert len(rows) == 6 and all(r["a.b"] == 1 and r["x`y"] == 3 for r in rows)
    with pytest.raises(ValueError, match="rename"):
        OPERATORS[name](docs.withColumn("__group", F.lit(1)), benchmark)
