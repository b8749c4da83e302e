import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.llm import lm_scoring, pieces, pii, token_counts
from tarnworks.llm.vocabulary import read_pieces
from tests.llm.helpers import empty, frame, odd

# ---- personal data

#: The contract's patterns.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(d):
    return sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d))) % 10 == 0


def brute_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(d) <= 19 and _luhn(d), "phone": 10 <= len(d) <= 15}
            if good[kind]:
                out.append((m.start(), place, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(out)]


def test_personal_data_base(spark):
    texts = [
        "mail a.b+c@host.example.org, ip 10.0.0.255 and 999.1.1.1 card 4111 1111 1111 1111 phone +1 (974) 555-3436.", "é\U0001f600 x@y.z_w@v.u..q@r.s", "1.2.3.4.5.6.7.8 001.002.003.0255 1.2.3.99999999999999",
        "@ @. a@b a@b. +12 +1 234 567 8901 2 4111111111111111 4111-1111-1111-1112", None, "", "9" * 20_000 + " " + "a" * 20_000 + "@b.c", "-".join("12" * 3000),
    ]
    random.seed(5)
    texts += ["".join(random.choice("a1@.+- ()%2") for _ in range(300)) for _ in range(40)]
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = brute_spans(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        assert set(want) - {""} <= set(got[i].spans.split(","))


def test_personal_data_bootstrap(spark):
    good = [f"payment card number 41111111111111{k:02d} was charged" for k in range(100)]
    seeds = [t for t in good if brute_spans(t)]
    missed = "payment card number 4111111111111111222 was charged"
    clean = ["release 2024-01-02-03 of part 1234567", "call it 55512345678 or not"]
    texts = seeds + [missed if not brute_spans(missed) else missed.replace("222", "223")] + clean
    got = {r.doc_id: r for r in pii.personal_data(frame(spark, texts)).collect()}
    assert got[len(seeds)].spans == "card:20:39" and got[len(seeds)].n_card == 0
    assert all(got[len(seeds) + 1 + k].spans == "" for k in range(2))


def test_personal_data_context_keeps_whole_words(spark):
    gaps = ["a " * 50, "b" * 100, "c " + "d" * 79, "e " + "f" * 80, "short one", ""]
    near = spark.createDataFrame([(g,) for g in gaps], "g string").select(pii._near(F.col("g"), False).alias("last"), pii._near(F.col("g"), True).alias("first")).collect()
    for g, r in zip(gaps, near):
        whole = g.split()
        assert all(w in whole for w in r["last"].split() + r["first"].split())
    assert near[2]["last"].split() == ["d" * 79] and near[3]["last"].split() == ["f" * 80] and near[1]["first"] == ""


def test_personal_data_odd_rows(spark):
    docs, rows = odd(spark)
    got = pii.personal_data(docs).collect()
    assert len(got) == len(rows) and sum(r.n_email for r in got) == 1
    assert pii.personal_data(empty(spark)).count() == 0


# ---- language model


def brute_marginal(lattice, weights, word):
    text, total = " " + word, 0.0

    def walk(i, p):
        nonlocal total
        if i == len(text):
            total += p * math.exp(weights[-1])
            return
        ends = set()
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in lattice.pieces:
                ends.add(j)
                walk(j, p * math.exp(weights[lattice.pieces[text[i:j]]]))
        if i + 1 not in ends:
            walk(i + 1, p * math.exp(sum(weights[len(lattice.pieces) + b] for b in text[i].encode())))

    walk(0, 1.0)
    return math.log(total)


def test_lattice_sums_all_segmentations():
    lattice = lm_scoring.Lattice(read_pieces())
    weights = lattice.weights()
    assert sum(map(math.exp, weights)) == pytest.approx(1)
    for word in ("the", "nation", "thntblere", "漢字", "a▁b", "", "éx9"):
        assert lattice.marginals(word, [weights])[0] == pytest.approx(brute_marginal(lattice, weights, word))
    counts = np.zeros(lattice.size)
    lattice.expect("nation", weights, counts)
    assert sum(len(p) * counts[k] for p, k in lattice.pieces.items()) == pytest.approx(len(" nation"))
    assert math.isfinite(lattice.marginals("x" * 50_000, [weights])[0])


def test_lm_base_and_score(spark):
    import zlib

    random.seed(3)
    vocabulary = ["".join(random.choice(["ter", "in", "on", "ka", "the"]) for _ in range(random.choice([1, 2, 3]))) for _ in range(300)]
    texts = [" ".join(random.choices(vocabulary, k=60)).title() for _ in range(150)] + [None, ""]
    got = {r.doc_id: r for r in lm_scoring.lm_scores(frame(spark, texts)).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    tokens = {i: [*(t or "").lower().split(), None] for i, t in enumerate(texts)}
    counts = {}
    for i, ts in tokens.items():
        for t in ts if not held[i] else ():
            counts[t] = counts.get(t, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for i, ts in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ts), sum(t in counts for t in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts.get(t, 0) + 1) / (n + v + 1)) for t in ts))
        assert r.score < 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) / sum(r.n_tokens for r in out) > -4


def brute_segmentations(lattice, word):
    """Every list of pieces (places in the list of weights) that spells the word behind its mark."""
    text = " " + word

    def walk(i):
        if i == len(text):
            yield ()
            return
        ends = [j for j in range(i + 1, len(text) + 1) if text[i:j] in lattice.pieces]
        for j in ends:
            yield from ((lattice.pieces[text[i:j]], *rest) for rest in walk(j))
        if i + 1 not in ends:
            spelling = tuple(len(lattice.pieces) + b for b in text[i].encode())
            yield from (spelling + rest for rest in walk(i + 1))

    return list(walk(0))


def brute_scores(rows, lattice, sweeps):
    """Scores of (doc_id, text, lang) by sums over all segmentations, after so many sweeps over all training words."""
    import zlib

    tokens = {i: (t or "").lower().split() for i, t, _ in rows}
    taught = [(i, lang) for i, _, lang in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    ways = {w: brute_segmentations(lattice, w) for ts in tokens.values() for w in ts}
    models, shares = [], []
    for lang in sorted({lang for _, lang in taught}):
        ids = [i for i, x in taught if x == lang]
        shares.append(len(ids) + 1)
        weights = np.array(lattice.weights())
        for _ in range(sweeps):
            counts = np.zeros(lattice.size)
            for word in (w for i in ids for w in tokens[i]):
                p = np.array([math.exp(weights[list(way)].sum()) for way in ways[word]])
                for way, share in zip(ways[word], p / p.sum()):
                    np.add.at(counts, list(way), share)
            counts[-1] = len(ids)
            weights = np.array(lattice.weights(counts))
        models.append(weights)
    word = {(w, k): math.log10(sum(math.exp(m[list(way)].sum()) for way in ways[w])) for w in ways for k, m in enumerate(models)}
    out = {}
    for i, ts in tokens.items():
        by_language = [math.log10(s / sum(shares)) + m[-1] / math.log(10) + sum(word[w, k] for w in ts) for k, (s, m) in enumerate(zip(shares, models))]
        out[i] = max(by_language) + math.log10(sum(10 ** (x - max(by_language)) for x in by_language))
    return out


def test_lm_score_against_all_segmentations(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PARTS", 1)
    random.seed(13)
    words = ["the", "other", "nation", "In", "é漢", "zq9", "a▁b", "over"]
    rows = [(i, " ".join(random.choices(words[i % 2 * 3 :], k=random.choice([0, 1, 6]))), "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    want = brute_scores(rows, lm_scoring.Lattice(read_pieces()), lm_scoring.SWEEPS + 1)
    got = {r.doc_id: r.score for r in lm_scoring.lm_scores(docs.repartition(3)).collect()}
    assert got.keys() == want.keys()
    for i, score in want.items():
        assert got[i] == pytest.approx(score, rel=1e-5)


def test_lm_same_blocks_when_splits_change(spark, tmp_path):
    random.seed(14)
    path = f"file://{tmp_path}/docs"
    docs = frame(spark, [" ".join(random.choices(["ka", "to", "mi", "ne", "su"], k=9)) + f" w{i}" for i in range(300)])
    docs.repartition(6).write.parquet(path)
    want = sorted(lm_scoring.lm_scores(spark.read.parquet(path)).collect())
    scores = lm_scoring.lm_scores(spark.read.parquet(path))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "1k")
        assert [r[:5] for r in sorted(scores.collect())] == [r[:5] for r in want]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lm_word_score_is_near_the_lattice_without_frequencies(spark):
    import zlib

    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    for r in lm_scoring.lm_scores(frame(spark, ["the word"] * len(ids), ids=ids)).collect():
        assert r.word_score == pytest.approx(r.score)


def test_lm_odd_rows(spark):
    docs, rows = odd(spark)
    got = lm_scoring.lm_scores(docs).collect()
    assert len(got) == len(rows) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    assert lm_scoring.lm_scores(empty(spark)).count() == 0
    alone = lm_scoring.lm_scores(frame(spark, ["the word"], ids=[next(i for i in range(99) if __import__("zlib").crc32(str(i).encode()) % 7 == 2)])).first()
    assert alone.train_tokens == 0 and alone.base_score == 0 and alone.score < 0


# ---- pieces


def brute_best(vocabulary, marked):
    """The greatest sum of scores over all segmentations, place by place over the whole text."""
    best = [0.0]
    for j in range(1, len(marked) + 1):
        ways = [best[i] + vocabulary.scores[vocabulary.ids[marked[i:j]]] for i in range(max(0, j - vocabulary.longest), j) if marked[i:j] in vocabulary.ids]
        if marked[j - 1] not in vocabulary.ids:
            ways.append(best[j - 1] + vocabulary.byte_score * len(marked[j - 1].encode()))
        best.append(max(ways))
    return best[-1]


def test_pieces_round_trip_and_best_score(spark):
    docs, rows = odd(spark)
    got = pieces.encode(docs)
    assert got.where("NOT round_trip").count() == 0 and got.select("doc_id").distinct().count() == len({r[0] for r in rows})
    random.seed(9)
    texts = ["".join(random.choice(["the ", "nation", "  ", "é", "漢", "\n", "▁", "x" * 40, "er", "Ex", "........"]) for _ in range(n)) for n in (0, 1, 5, 30, 200, 400)] + ["y" * 700, " " * 300]
    vocabulary = read_pieces()
    for size in (17, 40, 64, 1000):
        rows = pieces.encode(frame(spark, texts), size=size)
        back = {}
        for r in pieces.decode(rows).orderBy("doc_id", "chunk").collect():
            back[r.doc_id] = back.get(r.doc_id, "") + r.text
        assert back == dict(enumerate(texts))
        scores = {}
        for r in rows.collect():
            assert r.round_trip
            scores[r.doc_id] = scores.get(r.doc_id, 0.0) + r.score
        for i, t in enumerate(texts):
            assert scores[i] == pytest.approx(brute_best(vocabulary, " " + t) if t else 0.0)
    assert pieces.encode(empty(spark)).count() == 0


def test_max_plus_product_is_associative():
    random.seed(1)
    a, b, c = (np.array([[random.choice([-np.inf, *range(-9, 0)]) for _ in range(4)] for _ in range(4)]) for _ in range(3))
    assert (pieces.product(pieces.product(a, b), c) == pieces.product(a, pieces.product(b, c))).all()


# ---- token counts


def test_edits_count_like_a_whole_encoding(spark):
    tokens = token_counts.Tokens(token_counts.read_ranks())
    whole = lambda t: len(tokens.coder.encode_ordinary(t))
    random.seed(4)
    alphabet = ["the ", "nation", "  ", "\n", "\n\n ", "é", "漢字", "'s", "12", "!?", " x", "don't", "\t"]
    for n in (0, 1, 10, 100, 900):
        text = "".join(random.choice(alphabet) for _ in range(n))
        points, counts = tokens.leaves(text)
        tree = token_counts.tree_of(counts)
        assert tree[0] == whole(text) and sum(points) == len(text)
        for _ in range(40):
            start, removed = random.randrange(len(text) + 2), random.choice([0, 0, 1, 5, 60])
            added = "".join(random.choice(alphabet) for _ in range(random.choice([0, 1, 3, 80])))
            points, tree, again = token_counts.edited(tokens, text, points, tree, start, removed, added)
            start = min(start, len(text))
            text = text[:start] + added + text[start + removed :]
            assert tree[0] == whole(text) and sum(points) == len(text)
            assert tree == token_counts.tree_of(tree[(len(tree) + 1) // 2 - 1 :][: len(points)])


def test_edits_on_spark_count_like_whole_encodings(spark):
    whole = lambda t: len(token_counts.Tokens(token_counts.read_ranks()).coder.encode_ordinary(t))
    random.seed(18)
    texts = ["".join(random.choice(["the ", "nation", "  ", "\n", "é", "'s", "12", "!?", " x"]) for _ in range(n)) for n in (0, 1, 30, 300, 900, 900)] + [None]
    docs = frame(spark, texts)
    kept = token_counts.trees(docs)
    assert {r.doc_id: r.n_tokens for r in kept.collect()} == {i: whole(t or "") for i, t in enumerate(texts)}
    edits = token_counts.sample_edits(docs)
    made = {r.doc_id: r for r in edits.collect()}
    for r in token_counts.apply_edits(docs, kept, edits).collect():
        t, e = texts[r.doc_id] or "", made[r.doc_id]
        changed = t[: e.start] + e.added + t[e.start + e.removed :]
        assert (r.n_tokens, r.n_edited, r.tree[0], sum(r.points)) == (whole(t), whole(changed), whole(changed), len(changed))


def test_token_counts_odd_rows(spark):
    docs, rows = odd(spark)
    kept = token_counts.trees(docs)
    edits = token_counts.sample_edits(docs)
    got = token_counts.apply_edits(docs, kept, edits).collect()
    assert len(got) == len(rows)
    assert token_counts.apply_edits(empty(spark), token_counts.trees(empty(spark)), token_counts.sample_edits(empty(spark))).count() == 0
