from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from grovelift.llm import merkle
from grovelift.llm.merkle import (
    audited_manifest,
    dataset_proofs,
    expand_proofs,
    missing_nodes,
    tree_height,
    tree_levels,
)


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def path_of(leaves: list[str], place: int) -> tuple[list[tuple[str, str]], str]:
    """Siblings of one leaf per level, and the root, by building the whole tree."""
    out = []
    while len(leaves) > 1:
        start = place - place % 3
        run = leaves[start : start + 3]
        out.append(("".join(run[: place - start]), "".join(run[place - start + 1 :])))
        leaves = [h("".join(leaves[i : i + 3])) for i in range(0, len(leaves), 3)]
        place //= 3
    return out, leaves[0]


def brute(rows: list[dict]) -> list[tuple]:
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {
        s: sorted(
            (r for r in rows if r["source"] == s),
            key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)),
        )
        for s in sources
    }
    leaves = {s: [leaf_of(r) for r in own[s]] for s in sources}
    subroots = [path_of(leaves[s], 0)[1] for s in sources]
    out = []
    for at, s in enumerate(sources):
        above, root = path_of(subroots, at)
        for place, row in enumerate(own[s]):
            path = path_of(leaves[s], place)[0] + above
            folded = leaves[s][place]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = row["text"]
                folded = leaf_of(row | {"text": None if text is None else text.replace("\n", "")})
            for left, right in path:
                folded = h(left + folded + right)
            proof = h("".join(left + right for left, right in path))
            found = (row["doc_id"], leaves[s][place], subroots[at], root, proof, folded, folded == root)
            out.append(found)
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 28, 100])
def test_multiproof_of_any_range(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = tree_levels(leaves)
    assert len(levels) == tree_height(n) + 1
    rng = random.Random(n)
    for _ in range(20):
        first = rng.randrange(n)
        last = rng.randrange(first, n)
        needed = missing_nodes(first, last, n)
        assert len(set(needed)) == len(needed)
        fetched = {(level, place): levels[level][place] for level, place in needed}
        proofs, root = expand_proofs(first, leaves[first : last + 1], n, fetched)
        assert root == levels[-1][0]
        assert proofs == [path_of(leaves, place)[0] for place in range(first, last + 1)]
        # minimal: no node that follows from the leaves is fetched
        for level, place in needed:
            assert place * 3**level > last or (place + 1) * 3**level <= first
        # and none is left out that a proof holds
        for missing in needed:
            with pytest.raises(KeyError):
                expand_proofs(
                    first, leaves[first : last + 1], n, {k: v for k, v in fetched.items() if k != missing}
                )


def rows_of(n: int, seed: int) -> list[dict]:
    rng = random.Random(seed)
    sources = [None, "", "a", "ä", "zz", "hot"]
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "one\ntwo", "plain", "é\n\n|x", "long " * 500])
        source = "hot" if rng.random() < 0.5 else rng.choice(sources)
        rows.append(
            {
                "doc_id": i * 7 % n,
                "source": source,
                "lang": rng.choice([None, "en", "-"]),
                "n_chars": None if text is None else len(text),
                "text": text,
            }
        )
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("n, block_levels", [(1, 6), (60, 1), (200, 2), (61, 6)])
def test_against_whole_trees(spark, monkeypatch, n, block_levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block_levels)
    rows = rows_of(n, n)
    rows += [dict(rows[0])] * 5 + [rows[0] | {"doc_id": None, "text": "null\nid"}] * 2
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    for name in ("tree", "place", "block", "row", "leaf", "root", "proof", "n"):  # clashing names
        df = df.withColumn(name, F.lit("x"))
    got = sorted(map(tuple, audited_manifest(df).collect()), key=repr)
    assert got == brute(rows)
    assert any(r[-1] for r in got) and (n == 1 or not all(r[-1] for r in got))


def test_proofs_are_the_output(spark):
    df = spark.createDataFrame([(i, "s", None, 1, str(i)) for i in range(11)], SCHEMA)
    found = dataset_proofs(df, F.sha2(F.col("text").cast("binary"), 256)).collect()
    leaves = [h(str(i)) for i in range(11)]
    for r in found:
        assert r["row"] == r["place"] and r["leaf"] == leaves[r["place"]]
        path, root = path_of(leaves, r["place"])
        assert [tuple(x) for x in r["proof"]] == path and r["root"] == r["subroot"] == root


def test_empty(spark):
    got = audited_manifest(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[:2] == ["doc_id", "leaf"]
