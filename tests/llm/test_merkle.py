"""The manifest against a tree built in one place."""

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, odd_texts

from ledgerlens.llm import merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def one_leaf(row, more=0):
    values = (row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + more, row["text"])
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(nodes, fanout):
    """The root, and for every node its levels of (place, run)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for path, i in zip(paths, at):
            path.append((i % fanout, runs[i // fanout]))
        at = [i // fanout for i in at]
        nodes = [h("".join(r)) for r in runs]
    return nodes[0], paths


def plain(rows, fanout=2):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    first = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, one_leaf(r))
    trees = {g: plain_tree([one_leaf(r) for r in sorted(groups[g], key=first)], fanout) for g in order}
    root, above = plain_tree([trees[g][0] for g in order], fanout)
    out = []
    for g, up in zip(order, above):
        for row, path in zip(sorted(groups[g], key=first), trees[g][1]):
            i = row["doc_id"]
            odd = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
            node = one_leaf(row, int(odd))
            siblings = []
            for place, run in path + up:
                siblings += run[:place] + run[place + 1 :]
                node = h("".join([*run[:place], node, *run[place + 1 :]]))
            out.append((i, one_leaf(row), trees[g][0], root, h("".join(siblings)), node, node == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_rows(rng):
    rows = [{"doc_id": i, "source": rng.choice(["a", None, ""]), "lang": rng.choice(["en", "en", "en", "de", None, "", "é"]),
             "n_chars": rng.choice([None, 0, i, 2**63 - 1]), "text": t} for i, t in odd_texts()]
    rows += [{"doc_id": i, "source": "s", "lang": "en", "n_chars": 5, "text": f"text {i}"} for i in range(20, 77)]
    # Repeated rows, and unlike rows under one id.
    return rows + rows[:3] * 4 + [rows[30]] * 21 + [{**rows[25], "text": "other"}, {**rows[25], "doc_id": None}, {**rows[26], "doc_id": None}]


@pytest.mark.parametrize("fanout,block", [(2, 4), (2, 4096), (3, 9), (5, 5)])
def test_proofs(spark, fanout, block):
    rows = odd_rows(random.Random(fanout))
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumns({"tree": F.lit(1), "block": F.lit("x"), "root": F.lit(None), "leaf": F.lit(2)})
    if (fanout, block) == (2, 4096):
        assert found(merkle.op13_merkle(df)) == plain(rows)
    else:
        proofs = merkle.verified(merkle.manifest(merkle.document_leaves(df), fanout, block))
        shown = proofs.select("at", *(merkle.shown(c) for c in ("leaf", "subroot", "root")), F.sha2(merkle.shown("siblings"), 256),
                              merkle.shown("folded"), F.col("folded") == F.col("root"))
        assert found(shown) == plain(rows, fanout)


def test_one_row_and_none(spark):
    df = spark.createDataFrame([(3, "t", None, "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    [row] = merkle.op13_merkle(df).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h("") and row.verified
    assert merkle.op13_merkle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_trees(spark):
    """More groups than a block has leaves, and one that holds most rows."""
    rows = [{"doc_id": i, "source": None, "lang": f"l{i % 90}" if i % 3 else "hot", "n_chars": i, "text": str(i)} for i in range(400)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "doc_id long, source string, lang string, n_chars long, text string")
    proofs = merkle.verified(merkle.manifest(merkle.document_leaves(df), 2, 8))
    shown = proofs.select("at", *(merkle.shown(c) for c in ("leaf", "subroot", "root")), F.sha2(merkle.shown("siblings"), 256),
                          merkle.shown("folded"), F.col("folded") == F.col("root"))
    assert found(shown) == plain(rows)
