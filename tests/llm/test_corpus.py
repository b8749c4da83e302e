import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tarnworks.llm import chat, cotraining, mixing, quality_rules
from tests.llm.helpers import empty, frame, odd

# ---- mixing


def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    fixed = {}
    while True:
        rest = [s for s in order if s not in fixed]
        share = {s: (total - sum(fixed.values())) * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > epochs * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: epochs * sizes[s] for s in over}


def test_mixing_targets_and_takes(spark):
    random.seed(2)
    rows = [(i, " ".join(["w"] * random.choice([0, 1, 7, 100, 900])), "en", random.choice(["b", "a", None, "ü", "tiny"] if i % 40 else ["tiny"]), 1) for i in range(400)]
    rows = [r if r[3] != "tiny" or r[0] % 40 == 0 else (*r[:3], "hot", 1) for r in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = mixing.mix(docs).collect()
    assert sorted(mixing.mix(docs.repartition(7)).collect()) == sorted(got)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    targets, taken = brute_targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source], abs=1e-5)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 20
    mixed = mixing.mixed_documents(docs)
    words = Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
    assert words == Counter({r.doc_id: r.taken for r in got if r.taken})


def test_mixing_long_slots_meet_small_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 16)
    sizes = {"a": 60_000, "b": 900, "c": 9_000, "d": 60}
    rows = [(s, k, " ".join(["w"] * (n // 6))) for s, n in sizes.items() for k in range(6)]
    docs = spark.createDataFrame([(i, t, "en", s, 1) for i, (s, _, t) in enumerate(rows)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    taken, targets = Counter(), brute_targets(sizes)
    for r in mixing.mix(docs).collect():
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 1


def test_mixing_follows_its_schedule_at_long_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOTS", 64)
    sizes = {"a": 6_000, "b": 3_000, None: 900}
    docs = spark.createDataFrame([(f"{s}{k}", s, " ".join(["w"] * (n // 30))) for s, n in sizes.items() for k in range(30)], "name string, source string, text string")
    docs = docs.selectExpr("CAST(hash(name) AS BIGINT) AS doc_id", "text", "'en' AS lang", "source", "1L AS n_chars")
    right = {r.doc_id: r for r in mixing.mix(docs).collect()}
    ordered = mixing.mixed_documents(docs, order=True).orderBy("slot").collect()
    # any stretch of the mix is close to the targets, in words
    whole, seen, at = sum(len(r.text.split()) for r in ordered), Counter(), 0
    for r in ordered:
        seen[r.source] += len(r.text.split())
        at += len(r.text.split())
        target = next(x.target for x in right.values() if x.source == r.source)
        assert abs(seen[r.source] - target * at / whole) < 900
    assert {r.doc_id: len([x for x in r.slots if x is not None]) for r in right.values() if r.taken}.keys() == {r.doc_id for r in ordered}
    before = mixing.schedule

    def broken(targets, long, slots, first=0):
        return before(targets, long, slots, first).where("slot >= 20 OR source <> 'a'").where("block <> 1")

    monkeypatch.setattr(mixing, "schedule", broken)
    assert {r.doc_id: r.taken for r in mixing.mix(docs).collect()} != {k: r.taken for k, r in right.items()}


def test_schedule_is_even(spark):
    sizes = spark.createDataFrame([("a", 5000), ("b", 3000)], "source string, source_size bigint")
    plan = mixing.schedule(mixing.source_targets(sizes, (1, 1)), 1, 8000).orderBy("slot").collect()
    upto = np.cumsum([r.source == "a" for r in plan])
    assert np.abs(upto - 0.5 * np.arange(1, len(plan) + 1)).max() < 8
    seen = Counter()
    for r in plan:
        assert r.rank == seen[r.source]
        seen[r.source] += 1


def test_mixed_documents_of_one_id_go_by_their_rows(spark):
    rows = [(1, "x " * 10, "en", "x", 1), (1, "y " * 3, "en", "y", 1), (1, "z " * 3, "en", "y", 1), (2, "x " * 5, "en", "x", 1), (None, "y " * 4, "en", None, 1), (None, "y " * 4, "en", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    taken, words = Counter(), Counter()
    for r in mixing.mix(docs, (1, 3)).collect():
        taken[r.source] += r.taken
    for r in mixing.mixed_documents(docs, (1, 3)).collect():
        words[r.source] += len(r.text.split())
    assert words == taken and sum(words.values()) > 20


def test_mixing_odd_rows(spark):
    docs, rows = odd(spark)
    assert mixing.mix(docs).count() == len(rows)
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0
    assert [r.taken for r in mixing.mix(frame(spark, [None, "", " "])).collect()] == [0, 0, 0]


# ---- quality rules


def brute_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated)


def test_text_counts():
    random.seed(6)
    texts = [None, "", " \n", "a b a b a b a", "x\nx\n \n\ny\nx", "\x0b é 漢#", "a a a a", "a\x85b c", *(" ".join(random.choice("ab#\n|") for _ in range(60)) for _ in range(50))]
    for t in texts:
        got = quality_rules.text_counts(t)[:5]
        want = brute_counts(t)
        assert got == (want if want[0] else (0,) * 5), t


def brute_mcd(vectors):
    """Concentration from the same start on whole arrays; distances in full precision."""
    floors = np.diag((np.array(list(quality_rules.VECTOR.values())) * quality_rules.UNIT) ** 2)
    centre, inverse = np.median(vectors, axis=0), np.linalg.inv(floors)
    for _ in range(quality_rules.STEPS):
        d = np.einsum("ij,jk,ik->i", vectors - centre, inverse, vectors - centre)
        near = vectors[np.argsort(d)[: int(np.ceil(quality_rules.SHARE * len(d)))]]
        centre, cov = near.mean(axis=0), np.cov(near.T, bias=True)
        inverse = np.linalg.inv(cov / quality_rules.CONSISTENCY + floors)
    return np.sqrt(np.einsum("ij,jk,ik->i", vectors - centre, inverse, vectors - centre))


def test_quality_rejects_outliers_and_keeps_clean(spark):
    random.seed(8)
    rows = []
    for i in range(300):
        words = ["".join(random.choice("abcdefgh") for _ in range(random.choice([3, 5, 7]))) for _ in range(random.choice([60, 200, 2000]))]
        junk = i % 10 == 0
        rows.append((i, " ".join(w + "###" * junk for w in words), "en", "s", 1))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    counted = quality_rules.with_counts(docs).drop("text")
    got = {r.doc_id: r for r in quality_rules.judged(counted, *quality_rules.fit(counted)).collect()}
    assert all(r.kept == (i % 10 != 0) for i, r in got.items())
    distance = brute_mcd(np.array([[got[i][c] for c in quality_rules.VECTOR] for i in range(300)], float))
    assert np.allclose([got[i].distance for i in range(300)], distance, rtol=0.1, atol=0.1)
    assert quality_rules.good_documents(docs).count() == 270


def test_quality_determinant_is_the_least_of_all_halves(spark):
    """Groups of 13 rows against every subset of 9: the concentrated estimate has the least determinant, or one close to it."""
    from itertools import combinations

    rng = np.random.default_rng(3)
    groups = {}
    for g in range(12):
        rows = rng.normal([1600, 300, 200, 300], [150, 120, 160, 170], (13, 4))
        rows[: g % 4] += rng.normal(900, 300, (g % 4, 4))
        groups[f"g{g}"] = np.round(rows).astype(int)
    table = spark.createDataFrame([(g, *map(int, r)) for g, rows in groups.items() for r in rows], "`group` string, " + ", ".join(f"{c} bigint" for c in quality_rules.VECTOR))
    got = {r["group"]: r.logdet for r in quality_rules.concentrated(table).collect()}
    scale = np.array(list(quality_rules.VECTOR.values())) * quality_rules.UNIT

    def logdet(rows):
        return np.log(np.maximum(np.linalg.eigvalsh(np.cov(rows.T, bias=True) / quality_rules.CONSISTENCY / np.outer(scale, scale)), 1.0)).sum()

    off = {g: got[g] - min(logdet(rows[list(c)]) for c in combinations(range(13), 9)) for g, rows in groups.items()}
    assert all(-1e-3 < x < 1.0 for x in off.values()), off
    assert sum(x < 1e-3 for x in off.values()) >= 11, off


def test_quality_rejects_a_third_of_copies(spark):
    random.seed(9)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.choice([3, 5, 7])))
    texts = [" ".join(word() for _ in range(random.choice([60, 200, 900]))) for _ in range(200)]
    copies = [" ".join(f"w{k}#$%<>" for k in range(80))] * 100
    others = [" ".join(word() + "##" for _ in range(100)) for _ in range(5)]
    counted = quality_rules.with_counts(frame(spark, texts + copies + others)).drop("text")
    got = quality_rules.judged(counted, *quality_rules.fit(counted)).collect()
    assert {r.doc_id for r in got if r.kept} == set(range(200))


def test_quality_each_statistic_rejects_alone(spark):
    random.seed(10)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(random.choice([3, 5, 7])))
    texts = [" ".join(word() for _ in range(random.choice([100, 200, 400]))) for _ in range(200)]
    symbols = " ".join(f"abc{k:02}" + "#" * (k % 4 == 0) for k in range(100))
    block = [f"abc{k:02}" for k in range(23)]
    repeats = " ".join(block + [f"xyz{k:02}" for k in range(54)] + block)
    lines = "\n".join(random.sample([f"abc{k % 50:02}" for k in range(100)], 100))
    counted = quality_rules.with_counts(frame(spark, [*texts, symbols, repeats, lines])).drop("text")
    got = quality_rules.judged(counted, *quality_rules.fit(counted)).collect()
    assert not any(r.base_failed for r in got)
    assert {r.doc_id for r in got if r.kept} == set(range(200))


def test_quality_odd_rows(spark):
    docs, rows = odd(spark)
    got = quality_rules.quality(docs).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got if r.kept] in ([5], [])
    assert quality_rules.quality(empty(spark)).count() == 0 and quality_rules.good_documents(empty(spark)).count() == 0


# ---- chat


def brute_chat(rows):
    conversations = {}
    for c, turn, role, text in rows:
        conversations.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    said = {c: tuple(t[2:] for t in sorted(ts)) for c, ts in conversations.items()}
    prefixes = {ts[:k] for ts in said.values() for k in range(1, len(ts))}
    stay = {}
    for c, ts in said.items():
        if ts not in prefixes and (ts not in stay or (c is not None and (stay[ts] is None or c < stay[ts]))):
            stay[ts] = c
    return {c: "".join(f"<|im_start|>{r if there else 'unknown'}\n{t}<|im_end|>\n" for there, r, _, t in ts) for ts, c in stay.items()}


def test_chat_against_brute_force(spark):
    random.seed(7)
    rows = []
    for c in range(120):
        n = random.choice([1, 2, 3, 5])
        rows += [(c, k, random.choice(["user", "assistant"]) if random.random() < 0.1 else ["user", "assistant"][k % 2], random.choice(["hi", "yes"])) for k in range(n)]
    rows += [(200, k, "user", f"t{k}") for k in range(700)] + [(201, k, "user", f"t{k}") for k in range(300)]
    rows += [(None, None, None, None), (300, 1, "user", None), (301, 1, "user", ""), (302, 5, "user", "a"), (302, 5, "user", "a"), (303, 5, "user", "a")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, block int")
    got = {}
    for r in chat.chat_texts(table).orderBy("conv_id", "part").collect():
        assert r.n_turns <= chat.BLOCK
        got[r.conv_id] = got.get(r.conv_id, "") + r.text
    assert got == brute_chat(rows)
    assert chat.chat_texts(table.limit(0)).count() == 0


# ---- co-training


def test_cotraining_on_held_out_labels(spark):
    random.seed(11)
    rows, truth = [], {}
    for i in range(1500):
        good = random.random() < 0.7
        words = [random.choice(["ab", "abc", "abcd", "xyz"]) + random.choice("pqrst") for _ in range(80)]
        words += [random.choice(["nice", "fine"]) if good else random.choice(["spam$$", "junk##"]) for _ in range(6)]
        rows.append((i, " ".join(words), "en", random.choice("gggb" if good else "gbbb"), 500))
        truth[i] = int(good)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(i, truth[i]) for i in range(0, 1500, 3)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in cotraining.quality_scores(docs, labels).collect()}
    unseen = [i for i in range(1500) if i % 3]
    assert len(got) == 1500
    assert sum((got[i].p_good >= 0.5) == truth[i] for i in unseen) / len(unseen) > 0.97
    assert sum((got[i].p_meta >= 0.5) == truth[i] for i in unseen) / len(unseen) > 0.65


def brute_cotraining(rows, labels):
    """Both views on whole arrays of 0 and 1, without batches, bits or aggregates: p_good of each row."""
    c = cotraining
    tables = [np.zeros((len(rows), c.WORDS + c.BINNED)), np.zeros((len(rows), c.META))]
    for k, (_, text, lang, source, n_chars) in enumerate(rows):
        tables[0][k, c.text_features(text)] = 1
        tables[1][k, c.meta_features(lang, source, n_chars)] = 1
    label = np.array([labels.get(r[0], -1) for r in rows])
    held = np.array([zlib.crc32(str(r[0]).encode()) % c.HOLD_OUT == 0 and r[0] in labels for r in rows])
    centre = (np.arange(c._BINS) + 0.5) * 2 * c._REACH / c._BINS - c._REACH

    def line(odds):
        at = np.clip((odds[held] + c._REACH) / (2 * c._REACH) * c._BINS, 0, c._BINS - 1).astype(int)
        x, y = centre[at], label[held]
        s, o = 1.0, 0.0
        for _ in range(20_000):  # plain descent on the penalised loss
            p = 1 / (1 + np.exp(-np.clip(s * x + o, -500, 500)))
            gs, go = ((p - y) * x).sum() + (s - 1), (p - y).sum() + o
            w = p * (1 - p)
            s, o = s - gs / (1 + (w * x * x).sum() + (x * x).mean()), o - go / (1 + w.sum() + 1)
        return max(s, 0.0), o

    odds = [None, None]
    for _ in range(c.ROUNDS):
        new = []
        for k in (0, 1):
            y = label.copy()
            teacher = odds[1 - k]
            if teacher is not None:
                edge = math.log(c.SURE / (1 - c.SURE))
                y = np.where(label >= 0, label, np.where(teacher >= edge, 1, np.where(teacher <= -edge, 0, -1)))
            y = np.where(held, -1, y)
            n = np.array([(y == j).sum() for j in (0, 1)])
            count = np.stack([tables[k][y == j].sum(axis=0) for j in (0, 1)], axis=1)
            ratio = np.log((count[:, 1] + 0.5) / (n[1] + 1) * (n[0] + 1) / (count[:, 0] + 0.5))
            ratio[np.abs(ratio) < c.CLEAR * np.sqrt((1 / (count + 0.5)).sum(axis=1))] = 0
            words = c.WORDS if k == 0 else 0
            said = np.array([r[:words] @ ratio[:words] * c.VOICES / max(r[:words].sum(), c.VOICES) + r[words:] @ ratio[words:] for r in tables[k]])
            raw = said + math.log((n[1] + 1) / (n[0] + 1))
            slope, offset = line(raw)
            new.append(slope * raw + offset)
        odds = new
    slope, offset = line(odds[0] + odds[1])
    return 1 / (1 + np.exp(-(slope * (odds[0] + odds[1]) + offset)))


def test_cotraining_against_whole_arrays(spark):
    random.seed(16)
    rows, truth = [], {}
    for i in range(400):
        good = random.random() < 0.6
        words = [random.choice(["ab", "abc", "abcd", "xyz"]) + random.choice("pqrst") for _ in range(60)]
        words += [random.choice(["nice", "fine"]) if good and random.random() < 0.9 else random.choice(["spam$$", "junk##"]) for _ in range(5)]
        rows.append((i, " ".join(words), "en", random.choice("gggb" if good else "gbbb"), 500))
        truth[i] = int(good)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = {i: truth[i] for i in range(0, 400, 2)}
    got = {r.doc_id: r.p_good for r in cotraining.quality_scores(docs, spark.createDataFrame(list(labels.items()), "doc_id bigint, quality int")).collect()}
    assert np.allclose([got[i] for i in range(400)], brute_cotraining(rows, labels), atol=0.01)


def test_cotraining_odd_rows(spark):
    docs, rows = odd(spark)
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (77, 0)], "doc_id bigint, quality int")
    got = cotraining.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(r.p_good == 0.5 for r in got)
    assert cotraining.quality_scores(empty(spark), labels.limit(0)).count() == 0


# ---- pipeline


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "source mixing", "sentencepiece"]
    random.seed(12)
    texts = [" ".join(f"w{random.randrange(5000)}" for _ in range(120)) for _ in range(60)]
    texts += [texts[0], " " + texts[1], texts[2] + " more", "too short", None, "## " * 200]
    docs = frame(spark, texts)
    good = corpus_pipeline.quality_rules(spark, docs, "").cache()
    assert {r.doc_id for r in good.collect()} == set(range(63))
    once = corpus_pipeline.exact_dedup(spark, good, "").cache()
    assert {r.doc_id for r in once.collect()} == set(range(63)) - {60, 1}
    apart = corpus_pipeline.near_dedup(spark, once, "").cache()
    assert {r.doc_id for r in apart.collect()} == set(range(62)) - {60, 1} | {61}
    mixed = corpus_pipeline.source_mixing(spark, apart, "").cache()
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in apart.collect())
    assert mixed.columns == docs.columns
    coded = corpus_pipeline.sentencepiece(spark, mixed, "")
    assert coded.where("round_trip").count() == mixed.count()


def test_pipeline_against_brute_force(spark, tmp_path):
    """All stages of a small table at once, its groups being too small for estimates, against versions without Spark."""
    from tests.llm.test_dedup import _squeezed, brute_near

    random.seed(17)
    texts = [" ".join(f"w{random.randrange(900)}" for _ in range(random.choice([20, 60, 90]))) for _ in range(30)]
    texts += [texts[k] + "\n" for k in range(5)] + [t.replace(" ", "  ", 3) for t in texts[5:8]] + [" ".join([*t.split()[:-1], "x"]) for t in texts[8:14]] + [None, "a b " * 60]
    rows = [(i, t, "en", "ab"[i % 2], None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, component string")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, f"file://{tmp_path}").collect()

    stay = {}
    for i, t, *_ in rows:
        n, _, _, _, repeats = brute_counts(t)
        if n >= 50 and 100 * repeats <= 50 * n and ((h := _squeezed(t)) not in stay or len(t) > len(stay[h][1])):
            stay[h] = i, t
    groups = brute_near(list(stay.values()), 5)
    left = {i: texts[i] for i, _, component in groups if i == component}
    sizes = Counter()
    for i, t in left.items():
        sizes["ab"[i % 2]] += len(t.split())
    targets = brute_targets(sizes)
    assert all(r.round_trip for r in got) and {r.doc_id for r in got} <= set(left)
    from tarnworks.llm import pieces

    back = pieces.decode(spark.createDataFrame([(r.doc_id, r.chunk, r.ids) for r in got], "doc_id bigint, chunk bigint, ids array<int>")).collect()
    words = Counter()
    for r in back:
        assert left[r.doc_id].split()[: len(r.text.split())] == r.text.split()
        words["ab"[r.doc_id % 2]] += len(r.text.split())
    assert all(abs(words[s] - targets[s]) <= 20 for s in targets)


def test_pipeline_of_nothing(spark, tmp_path):
    empty(spark).write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
