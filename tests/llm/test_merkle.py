"""The Merkle manifest against a plain recomputation, and its edge cases."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from tidemark.llm.merkle import merkle_manifest
from tidemark.llm.queries import LEAF, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row: dict, lower: bool = False) -> str:
    values = []
    for c in LEAF:
        v = row[c]
        if v is None:
            values.append("-")
            continue
        v = str(v)
        if c == "text" and lower:
            v = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in v)
        values.append(f"{len(v.encode())}:{v}")
    return H(*values)


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and each node's (before, after) by level."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    level, width = nodes, 1
    while len(level) > 1:
        for i in range(len(nodes)):
            at = i // width
            run = at - at % 8
            paths[i].append(("".join(level[run:at]), "".join(level[at + 1 : run + 8])))
        level, width = [H(*level[i : i + 8]) for i in range(0, len(level), 8)], width * 8
    return level[0], paths


def expected(rows: list[dict]) -> list[tuple]:
    if not rows:
        return []
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[g] = tree([leaf_of(r) for r in groups[g]])
    root, tops = tree([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops, strict=True):
        subroot, paths = trees[g]
        for r, path in zip(groups[g], paths, strict=True):
            way = path + top
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            node = leaf_of(r, lower=bad)
            for before, after in way:
                node = H(before, node, after)
            proof = H("".join(b + a for b, a in way))
            out.append((r["doc_id"], leaf_of(r), subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


def run(spark, tmp_path, rows: list[dict]) -> list[tuple]:
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    for clash in ("grp", "pos", "n", "digest", "path", "key", "row", "root"):
        docs = docs.withColumn(clash, docs["source"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op13_merkle_manifest"](spark, str(tmp_path))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr)


def row(doc_id, text, lang, source="s", n_chars=1):
    return {"doc_id": doc_id, "text": text, "lang": lang, "source": source, "n_chars": n_chars}


def test_equals_recomputation_with_odd_rows(spark, tmp_path):
    rows = [row(i, f"Text {i} ÄÖ", "en") for i in range(530)]  # a short last run on several levels
    rows += [row(1000 + i, f"T{i}", "é") for i in range(9)] + [row(2000 + i, "X" * 9000, None) for i in range(8)]
    rows += [row(i, None, "z" + str(i)) for i in range(3000, 3011)]  # groups of one leaf
    rows += [row(None, "A", "en"), row(None, "B", "en", None, None), row(7, "Text 7 ÄÖ", "en"), row(7, "", "en"), row(-3, "Neg", "")]
    got = run(spark, tmp_path, rows)
    assert got == expected(rows)
    assert any(r[-1] for r in got) and any(not r[-1] for r in got)


@pytest.mark.parametrize("n", [0, 1, 8, 9])
def test_one_group_of_few_leaves(spark, tmp_path, n):
    rows = [row(i, f"Text {i}", "en") for i in range(n)]
    assert run(spark, tmp_path, rows) == expected(rows)


def test_groups_of_one_leaf_each(spark, tmp_path):
    rows = [row(i, "Same", f"l{i}") for i in range(10)]
    assert run(spark, tmp_path, rows) == expected(rows)


def test_other_columns_and_fanout(spark):
    rows = spark.createDataFrame([(i, "a" if i % 2 else None) for i in range(30)], "k int, g string")
    found = merkle_manifest(rows, ["k"], key="k", group="g", fanout=2).collect()
    assert len(found) == 30 and {len(r.path) for r in found} == {5} and len({bytes(r.root) for r in found}) == 1
