import hashlib
import random
import zlib

import pytest

from beaconry.llm import manifest
from tests.llm.helpers import DOCS, ODD, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def code(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def low(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def path_in(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 8 * 8:i // 8 * 8 + 8]
        out.append((run[:i % 8], run[i % 8 + 1:]))
        i //= 8
    return out


def brute(rows):
    """rows (doc_id, text, lang, source, n_chars)"""
    trees = {}
    for doc, text, lang, source, n in rows:
        crc = zlib.crc32(b"" if doc is None else str(doc).encode())
        head = code(doc) + code(source) + code(lang) + code(n)
        leaf = sha(head + code(text))
        trees.setdefault(lang, []).append((doc is not None, doc or 0, leaf, doc, sha(head + code(low(text))) if crc % 3 == 0 else leaf, crc % 3 == 0))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    own = {t: levels_of([x[2] for x in sorted(trees[t])]) for t in names}
    top = levels_of([own[t][-1][0] for t in names])
    out = []
    for at, t in enumerate(names):
        for i, (_, _, leaf, doc, given, tampered) in enumerate(sorted(trees[t])):
            path, now = path_in(own[t], i) + path_in(top, at), given
            for left, right in path:
                now = sha("".join(left) + now + "".join(right))
            proof = sha("".join("".join(a) + "".join(b) for a, b in path))
            out.append((doc, leaf, own[t][-1][0], top[-1][0], proof, now, now == top[-1][0], tampered))
    return sorted(out, key=str)


def table(n, langs, seed=1):
    rng = random.Random(seed)
    rows = [(i, prose(i, rng.randrange(12)).title() or None, rng.choice(langs), rng.choice(["a", None, "é"]), rng.randrange(9))
            for i in rng.sample(range(10 * n), n)]
    return rows


def result(df):
    names = [f.split()[0] for f in manifest.PROOF.split(", ")]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 63, 64, 65, 70, 511, 512, 513, 600])
def test_addresses(n):
    nodes = manifest.grow([bytes([i % 256, i // 256]) * 16 for i in range(n)], manifest.tall(n))
    by_level = [nodes_.copy() for nodes_ in [[bytes([i % 256, i // 256]) * 16 for i in range(n)]]]
    while len(by_level[-1]) > 1:
        by_level.append([manifest.parent(by_level[-1][i:i + 8]) for i in range(0, len(by_level[-1]), 8)])
    assert len(nodes) == sum(map(len, by_level))
    for h, level in enumerate(by_level):
        for i, node in enumerate(level):
            assert nodes[manifest.position(n, h, i)] == node


@pytest.mark.parametrize("levels", [1, 3])
def test_against_brute_force(spark, monkeypatch, levels):
    monkeypatch.setattr(manifest, "LEVELS", levels)
    monkeypatch.setattr(manifest, "BLOCK", 8 ** levels)
    langs = ["en"] * 12 + [None, "", "zß", "a", "-"] + [f"l{i}" for i in range(12 if levels == 1 else 0)]
    rows = table(700, langs)
    made = manifest.Manifest(spark.createDataFrame(rows, DOCS).repartition(7))
    got, want = result(made.proofs()), brute(rows)
    assert got == want
    assert made.root == want[0][3]
    assert {r[7] for r in want if not r[6]} == {True} and sum(not r[6] for r in want) > 100
    # The log holds every node once, at its place in the postorder of the whole tree.
    log = {}
    for r in manifest.log(made.rounds).collect():
        log.setdefault(r["tree"], {})[r["position"]] = r["digest"]
    for tree, nodes in log.items():
        own = sorted((r for r in brute_leaves(rows) if r[0] == tree), key=lambda r: r[1:])
        leaves = [bytes.fromhex(r[3]) for r in own]
        assert [nodes[i] for i in range(len(nodes))] == [n.hex() for n in manifest.grow(leaves, manifest.tall(len(leaves)))]


def brute_leaves(rows):
    return [("" if lang is None else "=" + lang, doc is not None, doc or 0, sha(code(doc) + code(source) + code(lang) + code(n) + code(text)))
            for doc, text, lang, source, n in rows]


def test_odd(spark):
    rows = [(d, t, None if d == 4 else "en", None, None if d == 6 else 3) for d, t in ODD] + [(None, None, "en", None, None)] * 3
    docs = spark.createDataFrame(rows, DOCS)
    got = result(manifest.manifest(docs.selectExpr("*", "1 AS tree", "2 AS name", "3 AS leaf", "4 AS n", "5 AS line", "6 AS block")))
    assert got == brute(rows)
    assert got == result(manifest.manifest(docs.repartition(5)))


def test_one_and_none(spark):
    one = [(5, "X", None, None, None)]
    assert result(manifest.manifest(spark.createDataFrame(one, DOCS))) == brute(one)
    none = manifest.Manifest(spark.createDataFrame([], DOCS))
    assert none.root is None and none.proofs().count() == 0
