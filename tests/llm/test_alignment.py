"""Token alignment against a version without Spark that uses another engine for A, and its odd cases."""

import base64
import hashlib
import os
from collections import Counter, defaultdict

import pytest

from tarnworks.llm import alignment as al
from tarnworks.llm.vocabulary import FOLDER, PIECES
from tests.llm.helpers import empty, frame, odd
from tests.oracle import SF_DIR, needs_tables

pytestmark = pytest.mark.skipif(not os.path.exists(al.BYTE_LEVEL), reason="no vocabularies here")


@pytest.fixture(scope="module")
def tokens():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    alphabet = al.byte_alphabet()

    def of(text):
        ids = a.encode(f" {text}", add_special_tokens=False)
        one = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(ids.ids, ids.tokens)]
        two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        return one, two

    return of


def brute(rows, tokens):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        one, two = tokens(text) if text else ([], [])
        want = b" " + (text or "").encode()
        if b"".join(t for _, t in one) != want or b"".join(t for _, t in two) != want:
            one = two = []
        ends = lambda side: [sum(len(t) for _, t in side[: k + 1]) for k in range(len(side))] if len(side) < 300 else _running(side)
        e1, e2 = ends(one), ends(two)
        links = [(x, y) for x, p in zip((i for i, _ in one), e1) for y in [dict(zip(e2, (i for i, _ in two))).get(p)] if y is not None] if len(one) < 300 else _links(one, two, e1, e2)
        counts.update(links)
        both, text_of, i, j = sorted(set(e1) & set(e2)), [], 0, 0
        for end in both:
            parts = []
            for side, at, k in ((one, e1, i), (two, e2, j)):
                stop = at.index(end, k) + 1
                parts.append((",".join(str(x) for x, _ in side[k:stop]), stop))
            text_of.append(f"{parts[0][0]}|{parts[1][0]}")
            i, j = parts[0][1], parts[1][1]
        docs.append((doc_id, len(one), len(two), len(both), links, hashlib.sha256(";".join(text_of).encode()).hexdigest() if one else ""))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(d, a, b, g, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), h) for d, a, b, g, x, h in docs]


def _running(side):
    out, at = [], 0
    for _, t in side:
        at += len(t)
        out.append(at)
    return out


def _links(one, two, e1, e2):
    there = dict(zip(e2, (i for i, _ in two)))
    return [(x, there[p]) for (x, _), p in zip(one, e1) if p in there]


def rows_of(df):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


TEXTS = [
    "the cat sat on the mat", "the cat  sat\non the mat", "<|endoftext|> <s> </s> <0x41> <unk>", "a▁b", "", None, " ", "\x00\x01é漢字 \U0001f600", "　ﬁ ½", "don't 123,456.78", "the the the the",
    " leading", "trailing  ", "\r\n\t", "ÀÉÎ õ 🇩🇪 é",
]


def test_against_brute_force(spark, tokens):
    rows = list(enumerate(TEXTS * 3))
    got = rows_of(al.alignment(frame(spark, TEXTS * 3).repartition(3)))
    assert got == sorted(brute(rows, tokens), key=repr)
    assert {r[0]: r[1:] for r in got}[3] == (0, 0, 0, 0, 0, 0, "")


def test_blocks_and_shared_ids_change_nothing(spark, tokens, monkeypatch):
    rows = list(enumerate((["the"] * 40 + TEXTS) * 2))
    docs = frame(spark, [t for _, t in rows]).repartition(2)
    monkeypatch.setattr(al, "BLOCK_DOCS", 5)
    monkeypatch.setattr(al, "BLOCK_TOKENS", 40)
    found = al.aligned(docs).where("b IS NOT NULL").select(*al.LIST)
    # "the" holds most links, so that its lists are dealt over several tasks
    spread = al.link_sums(found)
    assert rows_of(al.alignment(docs)) == sorted(brute(rows, tokens), key=repr)
    assert spread.agg({"n_best": "sum"}).first()[0] == sum(r[5] for r in brute(rows, tokens))


def test_odd_rows(spark, tokens):
    docs, rows = odd(spark)
    assert rows_of(al.alignment(docs)) == sorted(brute([r[:2] for r in rows], tokens), key=repr)
    assert al.alignment(empty(spark)).collect() == []


@needs_tables
def test_whole_table(spark, tokens):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(al.query(spark, SF_DIR)) == sorted(brute(rows, tokens), key=repr)


def test_ids_of_the_vocabulary_are_its_ranks():
    with open(f"{FOLDER}/byte_bpe_50k.tiktoken", "rb") as file:
        ranks = {int(i): base64.b64decode(t) for t, i in map(bytes.split, file)}
    assert al.byte_level().texts == [ranks[i] for i in range(len(ranks))]
