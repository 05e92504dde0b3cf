"""Small tables that the operators' tests share."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def documents(spark, rows, extra=""):
    """A documents table of (doc_id, text, source) rows, with other columns on request."""
    schema = "doc_id long, text string, source string" + extra
    return spark.createDataFrame(rows, schema).repartition(5)


def as_dict(df, key="doc_id"):
    out = {}
    for row in df.collect():
        assert row[key] not in out
        out[row[key]] = row
    return out


def morse_texts(size=1024):
    """Two words whose sums over powers of any odd base agree modulo 2 ** 64."""
    signs = [bin(k).count("1") % 2 for k in range(size)]
    return ["".join("ab"[k] for k in signs), "".join("ba"[k] for k in signs)]
