"""Extra columns named like any column that the operators use inside change nothing."""

import glob
import os
import re

import pandas as pd
import pytest

import corpus_pipeline
from tripflow.llm.queries import QUERIES

TABLES = "documents pages benchmark labels conversations".split()


def internal_names():
    found = set()
    for file in glob.glob(os.path.join(os.path.dirname(corpus_pipeline.__file__), "tripflow/llm/*.py")):
        with open(file) as f:
            text = f.read()
        found |= set(re.findall(r"[\"'](_?[A-Za-z]\w*)[\"']", text))
        found |= set(re.findall(r"(\w+)[ :]+(?:bigint|binary|string|double|int|boolean|array|struct)\b", text))
    return sorted({x.lower() for x in found})


@pytest.fixture(scope="module")
def folders(data, tmp_path_factory):
    """The given tables, some rows of each, as they are and with an extra column for every name."""
    plain, extra = (tmp_path_factory.mktemp(x) for x in ("plain", "extra"))
    names = internal_names()
    assert len(names) > 150 and {"_dropped", "_best", "_host", "_key", "block", "_row", "ids", "_group", "doc", "page"} <= set(names)
    for table in TABLES:
        rows = pd.read_parquet(f"{data}/{table}.parquet").head(60)
        rows.to_parquet(f"{plain}/{table}.parquet")
        others = pd.DataFrame({n: f"extra {n}" for n in names if n not in rows.columns}, index=rows.index)
        pd.concat([others, rows], axis=1).to_parquet(f"{extra}/{table}.parquet")
    return str(plain), str(extra)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_take_any_extra_column(spark, folders, name):
    plain, extra = (sorted(map(str, QUERIES[name](spark, folder).collect())) for folder in folders)
    assert plain == extra and plain


def test_stages_take_any_extra_column(spark, folders):
    plain, extra = folders
    kept = {}
    for folder in folders:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stage(spark, docs, folder)
            assert after.columns == docs.columns
            kept.setdefault(name, []).append(sorted(r.doc_id for r in after.select("doc_id").collect()))
    assert all(a == b and a for a, b in kept.values())
    assert corpus_pipeline.run(spark, extra).count() == corpus_pipeline.run(spark, plain).count()
