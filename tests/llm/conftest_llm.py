"""Helpers of these tests."""

import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"


def documents(sf_dir):
    table = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_id(df, key="doc_id"):
    rows = [r.asDict() for r in df.collect()]
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out
