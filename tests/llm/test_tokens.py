import gc
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from filings_audit.llm import bpe, packing, tokencount
from filings_audit.llm.common import map_texts
from filings_audit.llm.queries import op5_token_counts, op6_bpe, op10_packing

BYTE_BPE, WORD_BPE, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
SCHEMA = "doc_id long, text string, ids string, length string, piece string, n_tokens string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in enumerate(texts)], SCHEMA)


def odd_texts(seed=1, n=400):
    r = random.Random(seed)
    letters = "abcdeéüßİΣσ  \n\t'stre\x1c\x85\xa0 日本🙂́ 0123!?.,'ll<|endoftext|>"
    entries = sorted(Tokenizer.from_file(BYTE_BPE).get_vocab())
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(n)]
    texts += [" ".join(r.sample(entries, 10)) + "".join(r.sample(entries, 5)) for _ in range(n // 2)]
    texts += [None, "", " ", "   a", "a" * 3000, " " * 300 + "x", "<|endoftext|> <|startoftext|>x", "é ́. á.", "Ω'S it's. I'LL,"]
    return texts + ["the cat sat", "the cat sat", "word " * 40_000]


def test_encoding_equals_the_library_and_decodes_back(spark):
    texts = odd_texts()
    encoded = bpe.encode(frame(spark, texts).repartition(3), BYTE_BPE, ["doc_id"])
    library = Tokenizer.from_file(BYTE_BPE)
    wanted = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in encoded.collect()} == wanted
    back = {r.doc_id: r.text for r in bpe.decode(encoded, BYTE_BPE, ["doc_id"]).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}


def test_decoding_broken_ids_equals_the_library(spark):
    r = random.Random(2)
    ids = [[r.randrange(50257) for _ in range(8)] for _ in range(200)] + [[]]
    rows = spark.createDataFrame([(i, np.array(x, "<u4").tobytes()) for i, x in enumerate(ids)], "doc_id long, ids binary")
    library = Tokenizer.from_file(BYTE_BPE)
    got = {r.doc_id: r.text for r in bpe.decode(rows, BYTE_BPE, ["doc_id"]).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)}


def test_a_small_cache_changes_nothing(spark, monkeypatch):
    texts = odd_texts(seed=4, n=60)
    encode = bpe._encoder(BYTE_BPE)()
    whole = encode(texts)[0]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    again = bpe._encoder(BYTE_BPE)()
    assert [x for t in texts for x in again([t])[0]] == whole


def test_op6_query(spark, sf_dir):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    library = Tokenizer.from_file(BYTE_BPE)
    for r in op6_bpe(spark, sf_dir).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def best_by_hand(word, scores):
    """Pieces of the best segmentation, character by character."""
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (best[start][0] + scores[word[start:end].encode()], best[start][1] - 1)
            for start in range(end) if word[start:end].encode() in scores
        ]
        size = len(word[end - 1].encode())
        options = options or [(best[end - 1][0] + size * tokencount.UNKNOWN_BYTE, best[end - 1][1] - size)]
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_against_plain_dynamic_programming(spark):
    scores = tokencount.piece_scores(PIECES)
    texts = [t for t in odd_texts(seed=3, n=150) if t is None or len(t) < 5000]
    got = {r.doc_id: (r.n_words, r.n_tokens) for r in tokencount.count_tokens(frame(spark, texts), PIECES, ["doc_id"]).collect()}
    white = "\t\n\x0b\x0c\r \x85\xa0 "
    for i, text in enumerate(texts):
        words = "".join(" " if c in white else c for c in text or "").split(" ")
        words = [w for w in words if w]
        assert got[i] == (len(words), sum(best_by_hand("▁" + w, scores) for w in words)), repr(text)[:80]


def test_op5_query(spark, sf_dir):
    assert op5_token_counts(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        gaps.remove(min(fitting)) if fitting else None
        gaps.append((min(fitting) if fitting else capacity) - length)
    return len(gaps)


@pytest.mark.parametrize("capacity,low,high,n", [(64, 1, 64, 500), (64, 1, 12, 800), (100, 30, 60, 300), (7, 7, 7, 9), (5, 1, 1, 1)])
def test_plan_is_gapless_and_as_good_as_one_at_a_time(capacity, low, high, n):
    r = random.Random(n)
    lengths = [r.randint(low, high) for _ in range(n)]
    moves = packing.plan(Counter(lengths), capacity)
    fill = Counter()
    placed = Counter()
    for length, rank, count, first, offset in sorted(moves.tolist(), key=lambda m: m[4]):
        for sequence in range(first, first + count):
            assert fill[sequence] == offset and offset + length <= capacity
            fill[sequence] += length
        placed[length] += count
    assert placed == Counter(lengths)
    assert len(fill) <= best_fit_decreasing(lengths, capacity) * 1.02 + 1


def check_packing(rows, texts, capacity):
    """rows: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    library = Tokenizer.from_file(WORD_BPE)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        for k, r in enumerate(pieces):
            part = ids[k * capacity : (k + 1) * capacity]
            assert (r.piece, r.start, r.length) == (k, k * capacity, len(part)), i
            assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        assert sum(r.length for r in pieces) == len(ids)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_cut_and_pack(spark):
    from pyspark.sql import functions as F

    texts = odd_texts(seed=6, n=200)
    pieces = packing.cut(frame(spark, texts).repartition(3), WORD_BPE, 50, 1).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    rows = packing.pack(pieces, 50, ["doc_id", "piece", "start", "length", "ids_crc32"]).collect()
    used = check_packing(rows, dict(enumerate(texts)), 50)
    assert used <= 1.02 * best_fit_decreasing([r.length for r in rows], 50) + 1


def test_cutting_and_ranking_never_take_two_workers_of_one_task(spark, monkeypatch):
    plans, write = [], packing.materialize

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(packing, "materialize", noted)
    pieces = packing.cut(frame(spark, ["a b", "c", None]), WORD_BPE, 50, 1).drop("ids")
    assert packing.pack(pieces, 50, ["doc_id", "length"]).count() == 3
    assert max(plan.count("MapInArrow") for plan in plans) == 1


def test_a_worker_drops_what_another_operator_has_kept(spark):
    docs = frame(spark, ["a b", "c", "d e", "f"] * 4).repartition(4)

    def make():
        kept = sum(type(x).__name__ == "Words" for x in gc.get_objects())
        return lambda texts: [[kept] * len(texts)]

    def words():
        return sum(r.n for r in map_texts(docs, ["doc_id"], "text", "n long", make, uses).collect())

    assert packing.cut(docs, WORD_BPE, 50, 1).count() == 16
    uses = ("packing words", WORD_BPE)
    assert words() > 0  # a task of the same operator finds them
    uses = None
    assert words() == 0


def test_words_of_lower_case_letters_are_cut_and_encoded_the_short_way():
    class Once:
        def __init__(self, tokenizer):
            self.tokenizer, self.texts = tokenizer, []

        def encode_batch_fast(self, texts, add_special_tokens):
            self.texts += texts
            return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    def search(text):
        raise AssertionError("searched")

    words = packing.load_words(WORD_BPE)
    words.tokenizer = full = Once(words.tokenizer)
    library, r = Tokenizer.from_file(WORD_BPE), random.Random(7)

    def ids(text):
        found = words.of(text)
        known = words.learn(set(found))
        return np.frombuffer(b"".join(known[w] for w in found), "<u4").tolist()

    characters = [chr(c) for c in range(256)] + list("abc 12'., ") * 6 + ["\u212a", "\u212b", "日", "Σ"]
    for text in ["".join(r.choices(characters, k=r.randint(1, 30))) for _ in range(3000)]:
        assert ids(text) == library.encode(text, add_special_tokens=False).ids, text
    words.known.clear()
    full.texts.clear()
    words.latin = words.latin_endings = words.any = search
    text = "Äpfel and Straße, 12 more\u00a0words. µ ª"
    assert ids(text) == library.encode(text, add_special_tokens=False).ids
    assert set(full.texts) <= set("12,.")  # no letters pass through the whole tokenizer


def test_pack_refuses_lengths_out_of_bounds_and_takes_an_empty_table(spark):
    rows = spark.createDataFrame([(1, 5), (2, 9)], "doc_id long, length long")
    assert packing.pack(rows.limit(0), 8, ["doc_id"]).collect() == []
    with pytest.raises(Exception, match="between 1 and 8"):
        packing.pack(rows, 8, ["doc_id"])


def test_op10_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op10_packing(spark, sf_dir).collect()
    used = check_packing(rows, texts, 4096)
    assert used <= 1.01 * best_fit_decreasing([r.length for r in rows], 4096) + 1


@pytest.mark.parametrize("name", ["Offset", "sequence_id", "__part"])
def test_pack_refuses_columns_named_like_its_own(spark, name):
    rows = spark.createDataFrame([(1, 2)], f"`{name}` long, length long")
    with pytest.raises(ValueError, match="named like results"):
        packing.pack(rows, 8, [name])
