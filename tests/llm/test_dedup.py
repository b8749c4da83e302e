import hashlib
import random
import re

from pyspark.sql import functions as F

from tarnworks.llm import exact_dedup, near_dedup
from tarnworks.llm.components import components
from tarnworks.session import fresh_path
from tests.llm.helpers import empty, frame, odd


def _squeezed(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text or "").encode()).hexdigest()


def brute_exact(rows):
    best = {}
    for i, t in rows:
        key = (len(t or ""), i is not None, -(i or 0))
        if (h := _squeezed(t)) not in best or key > best[h][0]:
            best[h] = key, i
    return sorted(((i, best[_squeezed(t)][1], sum(_squeezed(u) == _squeezed(t) for _, u in rows), _squeezed(t)) for i, t in rows), key=str)


def test_exact_against_brute_force(spark):
    docs, rows = odd(spark)
    got = exact_dedup.exact_dedup(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_exact([r[:2] for r in rows])
    kept = exact_dedup.deduplicate(docs)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert kept.count() == len({_squeezed(r[1]) for r in rows})
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0 and exact_dedup.deduplicate(empty(spark)).count() == 0


def test_exact_index_over_loads(spark):
    path = fresh_path(spark, "test-index")
    first = exact_dedup.exact_dedup(frame(spark, ["a b", "c d", "c  d"]), path, 4)
    assert {r.doc_id: r.keep_id for r in first.collect()} == {0: 0, 1: 2, 2: 2}
    again = exact_dedup.exact_dedup(frame(spark, ["ab", "e", "c   d"], ids=[10, 11, 12]), path, 4)
    assert {r.doc_id: (r.keep_id, r.kept) for r in again.collect()} == {10: (0, False), 11: (11, True), 12: (12, True)}
    index = exact_dedup.DigestIndex(spark, path, 4)
    assert index.keepers().count() == 3
    assert index.rows().count() <= 6


def _set(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def brute_near(rows, width):
    sets = {i: _set(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def _corpus(seed, n):
    random.seed(seed)
    words = [f"w{k}" for k in range(3000)]
    passage = [random.choice(words) for _ in range(120)]
    base = [[random.choice(words) for _ in range(random.choice([1, 3, 5, 20, 60, 150, 400]))] for _ in range(n // 4)]
    texts = []
    for k in range(n):
        t = list(random.choice(base))
        for _ in range(random.choice([0, 0, 1, 2, 5, 12])):
            t[random.randrange(len(t))] = random.choice(words)
        if k % 5 == 0:
            at = random.randrange(len(t) + 1)
            t[at:at] = passage
        texts.append(" ".join(t))
    hub = [random.choice(words) for _ in range(200)]
    for _ in range(40):  # a group of near copies, each a little different
        t = list(hub)
        for _ in range(random.choice([1, 3, 6])):
            t[random.randrange(len(t))] = random.choice(words)
        texts.append(" ".join(t))
    return texts


def test_near_against_brute_force(spark):
    for seed in (1, 2):
        texts = _corpus(seed, 200)
        got = near_dedup.near_duplicates(frame(spark, texts), 4).collect()
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(list(enumerate(texts)), 4)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def _variants(n, apart):
    """Variants of one text that is not there, four of its 204 words replaced in each; where these are apart, nearly all pairs are just below the similarity."""
    random.seed(n)
    hub = [f"w{k}" for k in range(204)]
    texts = []
    for k in range(n):
        t = list(hub)
        for at in [51 * j + random.randrange(4, 47) for j in range(4)] if apart else random.sample(range(204), 4):
            t[at] = f"x{k}y{at}"
        texts.append(" ".join(t))
    return texts


def _candidates(spark, texts):
    sets = near_dedup.full_sets(frame(spark, texts), 4).withColumns({"rep": F.col("doc_id"), "component": F.col("doc_id")})
    return near_dedup.unsettled_pairs(sets).count()


def _links(texts):
    sets = [_set(t, 4) for t in texts]
    return sum(100 * len(a & b) >= 80 * len(a | b) for k, a in enumerate(sets) for b in sets[k + 1 :])


def test_near_variants_without_their_centre_make_few_pairs(spark):
    for n in (300, 1200):
        assert _candidates(spark, _variants(n, True)) <= n * (n - 1) / 2 / 100
    texts = _variants(300, False)
    assert _candidates(spark, texts) <= 5 * _links(texts)
    texts += [" ".join([*t.split()[:-6], "a", "b", "c"]) for t in texts[:30]]
    got = near_dedup.near_duplicates(frame(spark, texts), 4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(list(enumerate(texts)), 4)


def test_near_chains_of_variants(spark):
    random.seed(15)
    words, texts = [f"w{k}" for k in range(120)], []
    for k in range(90):  # each a little off the one before it, so that no leader is near all
        words = list(words)
        words[random.randrange(120)] = f"v{k}"
        texts.append(" ".join(words))
    got = near_dedup.near_duplicates(frame(spark, texts), 4).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(list(enumerate(texts)), 4)


def test_near_odd_rows(spark):
    docs, rows = odd(spark)
    got = near_dedup.near_duplicates(docs, 4).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[4].component_id == 3 and by_id[1].n_shingles == 0 and by_id[2].kept
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    assert near_dedup.without_near_duplicates(docs).where("doc_id = 4").count() == 0


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(200, 100), (300, 100), (300, 400), (5, 5)], "a bigint, b bigint")
    got = dict(components(links).collect())
    assert got == {**{k: 1 for k in range(1, 61)}, **{k: 100 for k in (100, 200, 300, 400)}}
