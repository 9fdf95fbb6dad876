from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from conftest import ODD
from waymark.llm import simhash


def plain(text: str | None, k: int = 4) -> int:
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [*(t for t in ODD if t is None or len(t) < 1000), "One two THREE four five six seven", "a b c", "É é İ K"])
def test_fingerprint_of_the_definition(text):
    assert simhash.fingerprint(text) == plain(text)


def closed(values: list[int], most: int = 4) -> dict[int, int]:
    root = {v: v for v in values}
    moved = True
    while moved:
        moved = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= most and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    moved = True
    return root


@pytest.mark.parametrize("task_variants", [1 << 22, 1 << 11])
def test_links_equal_brute_force_with_and_without_split_buckets(spark, task_variants):
    r = random.Random(4)
    flip = lambda v, n: v ^ sum(1 << b for b in r.sample(range(64), n))
    centre = [r.getrandbits(64) for _ in range(12)]
    values = sorted({*centre, *(flip(c, n) for c in centre for n in (1, 2, 3, 4, 5, 6)), *(flip(flip(centre[0], 3), 3) for _ in range(20)), 0, (1 << 64) - 1})
    signed = lambda v: int(np.uint64(v).astype(np.int64))
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp LONG")
    found = {x.node: x.root for x in simhash.connect(simhash.links(frame, task_variants=task_variants)).collect()}
    want = closed(values)
    pairs = {(want[v], found.get(signed(v), signed(v))) for v in values}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_components_of_documents(spark, docs):
    r = random.Random(2)
    base = [" ".join(r.choice("abcdefghij") * r.randint(1, 6) for _ in range(400)) for _ in range(6)]
    texts = [*ODD, *base, *base[:3], base[3].replace(" a ", " b ", 1)]
    rows = {x.doc_id: x for x in simhash.components(docs(texts)).collect()}
    prints = [plain(t) for t in texts]
    root = closed(sorted(set(prints)))
    first: dict = {}
    for k, p in enumerate(prints):
        first.setdefault(root[p], k)
    assert {k: rows[k].component_id for k in rows} == {k: first[root[p]] for k, p in enumerate(prints)}
    kept = simhash.deduplicated(docs(texts))
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(first.values())) and kept.columns == docs(texts).columns


def test_several_tables_link_whatever_one_links(spark, docs):
    r = random.Random(8)
    base = " ".join(r.choice("abcdefghij") * r.randint(1, 6) for _ in range(300))
    words = base.split()
    texts = [base]
    for n in (1, 2, 4, 6):
        w = list(words)
        for at in r.sample(range(300), n):
            w[at] = "zz"
        texts.append(" ".join(w))
    texts += [" ".join(r.sample(words, 300)) for _ in range(5)]
    one = {x.doc_id: x.component_id for x in simhash.components(docs(texts)).collect()}
    many = {x.doc_id: x.component_id for x in simhash.components(docs(texts), tables=4).collect()}
    assert all(many[k] <= one[k] for k in one) and all(many[k] == k for k in range(5, 10))


def test_empty_table_repeated_ids_and_null_ids(spark, docs):
    assert simhash.components(docs([])).count() == 0 and simhash.deduplicated(docs([])).count() == 0
    rows = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "z y x")], "doc_id LONG, text STRING")
    assert sorted((x.doc_id, x.component_id) for x in simhash.components(rows).where("doc_id IS NOT NULL").collect()) == [(1, 1), (1, 1), (2, 2)]
    assert sorted(str(x.doc_id) for x in simhash.deduplicated(rows).collect()) == ["1", "2", "None"]


def test_a_group_of_copies_stays_linear(spark, docs):
    out = simhash.components(docs(["the very same text here"] * 3000)).select("component_id").distinct().collect()
    assert [x.component_id for x in out] == [0]


def test_rows_of_one_id_are_kept_by_their_texts(spark):
    a, b = "a b c d e f g", "z y x w v u t"
    rows = spark.createDataFrame([(3, a, 1), (5, a, 2), (5, b, 3)], "doc_id LONG, text STRING, of_text INT")
    assert sorted((x.doc_id, x.text) for x in simhash.deduplicated(rows).collect()) == [(3, a), (5, b)]


def test_a_long_chain_is_followed_to_its_end(spark):
    n = 700
    edges = spark.createDataFrame([(k, k + 1) for k in range(n)], "u LONG, v LONG")
    assert {x.root for x in simhash.connect(edges).collect()} == {0}
