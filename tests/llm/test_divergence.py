"""The divergence of sources against a version without Spark, and its odd cases."""

import re
from collections import Counter, defaultdict

from tarnworks.llm import source_divergence as sd
from tests.llm.helpers import DOCS, empty, odd

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=3, ranks=200):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        group = (lang or "", source or "")
        groups.add(group)
        terms = TERM.findall((text or "").translate(UPPER))
        counts[group].update(terms)
        docs[group[0]].update(set(terms))
    kept = {lang: {t for t, n in docs[lang].items() if n >= least} for lang, _ in groups}
    words = {g: sum(counts[g][t] for t in kept[g[0]]) for g in groups}
    whole = {lang: Counter() for lang, _ in groups}
    for (lang, _), c in counts.items():
        whole[lang].update({t: n for t, n in c.items() if t in kept[lang]})
    share = lambda n, total, v: 1 + 10**9 * (n + 1) // (total + v)
    out = []
    for g in groups:
        lang, v = g[0], len(kept[g[0]])
        p = {t: share(counts[g][t], words[g], v) for t in kept[lang]}
        pairs = []
        for h in groups:
            if h[0] == lang and h != g:
                q = {t: share(counts[h][t], words[h], v) for t in kept[lang]}
                pairs.append((-sum((p[t] - q[t]) ** 2 // q[t] for t in p), h[1]))
        total = sum(whole[lang].values())
        q = {t: share(whole[lang][t], total, v) for t in kept[lang]}
        terms = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in p if counts[g][t] and p[t] > q[t]]
        out += [(*g, "pair", s, -x, k) for k, (x, s) in enumerate(sorted(pairs), 1)]
        out += [(*g, "term", t, -x, k) for k, (x, _, t) in enumerate(sorted(terms)[:ranks], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sd, "SLICE", 64)
    monkeypatch.setattr(sd, "GATHERED", 50)
    words = ["the", "A", "É", "é", "Zebra", "zebra9x", "漢字", "\U0001f600", "b-c", "x_y", "İ"]
    rows = [(" ".join(words[(i * k + j) % (3 + i % 9)] for j in range(40 + i)), ["en", "de", None][i % 3], ["s", "t", "", None, "u"][k % 5]) for i in range(40) for k in range(3)]
    rows += [(None, "en", "bare"), ("", "fr", "one"), ("\n\t 12", "fr", "two"), ("single", "it", "alone")]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = rows_of(sd.divergence(docs))
    assert got == brute(rows)
    assert {r[:4]: r[4] for r in got}["fr", "one", "pair", "two"] == 0
    few = rows_of(sd.divergence(docs, ranks=2))
    assert few == [r for r in got if r[2] == "pair" or r[5] <= 2]


def test_histograms_have_every_kept_term(spark):
    rows = [(f"w{'abcdefgh'[k % 8]} common {'only' if k < 4 else ''}", "en", f"s{k % 3}") for k in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    kept = sd.profiles(docs)
    groups = spark.createDataFrame([("en", f"s{k}", 0, kept.count()) for k in range(3)], "lang string, source string, words long, terms long")
    cells = sd.pair_histograms(kept, groups).where("times <> 0").collect()
    for pair in {(r.one, r.two) for r in cells}:
        own = [r for r in cells if (r.one, r.two) == pair]
        assert sum(r.times for r in own) == kept.count() and min(r.times for r in own) > 0
    assert len({(r.one, r.two) for r in cells}) == 3


def test_odd_rows(spark):
    docs, rows = odd(spark)
    assert rows_of(sd.divergence(docs)) == brute([(r[1], r[2], r[3]) for r in rows])
    assert sd.divergence(empty(spark)).collect() == []
    assert sd.divergence(spark.createDataFrame([(1, None, None, None, None)] * 4, DOCS)).collect() == []
