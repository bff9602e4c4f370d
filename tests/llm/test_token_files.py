import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from histlake.llm import token_files as tf


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain(tokenizer, rows):
    """(id, start, n_tokens, crc) of rows in the files' order, each text encoded as a whole."""
    out, start = [], 0
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD = ["", None, " ", "\n\t\v\f\r ", "Hello,  World!\nIt's  'they'll' 12345", "a\vb\fc\td\re\nf", "İstanbul ΣΊΣΥΦΟΣ ΟΔΟΣ ΟΔΟΣ.", "é e ́x ́",
       "日本語のテキスト　です", "a b c\u0085d", "<|endoftext|> x<|endoftext|>y <|startoftext|>\n<|endoftext|>", "🙂🙂👨‍👩‍👧 \x00\x1c\x1f z",
       "x" * 5000, "näive " * 40, "ﬁ 가 ᄀ ᅡ"]


def test_runs_give_the_ids_of_whole_texts(tokenizer):
    texts = [t or "" for t in ODD]
    ids, ends = tf.Encoder(None, 1, True)(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, [0, *ends], ends):
        assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8))
def test_runs_give_the_ids_of_whole_texts_at_random(texts):
    encoder = _encoder(True)
    ids, ends = encoder(pa.array(texts, pa.string()))
    whole, whole_ends = _encoder(False)(pa.array(texts, pa.string()))
    assert ids.tolist() == whole.tolist() and ends.tolist() == whole_ends.tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aB'sSTtLl ére<|>.,!0 9ßÿÀ×÷\n\t", max_size=40), max_size=8))
def test_plain_pieces_give_the_ids_of_whole_texts(texts):
    ids, ends = _encoder(True)(pa.array(texts, pa.string()))
    whole, whole_ends = _encoder(False)(pa.array(texts, pa.string()))
    assert ids.tolist() == whole.tolist() and ends.tolist() == whole_ends.tolist()


def _encoder(parted, made={}):  # noqa: B006 - one tokenizer for all examples
    if parted not in made:
        made[parted] = tf.Encoder(None, 1, parted)
    return made[parted]


def test_a_workers_tasks_share_what_was_learnt(monkeypatch):
    texts = pa.array(["some words are learnt once", "and some others", "日本語"])
    first = tf.worker_encoder(None, 1, True)
    ids, ends = first(texts)
    asked = []
    monkeypatch.setattr(tf, "encoded", lambda tokenizer, texts, real=tf.encoded: asked.extend(texts) or real(tokenizer, texts))
    second = tf.worker_encoder(None, 1, True)
    again, again_ends = second(texts)
    assert second is first and not asked
    assert again.tolist() == ids.tolist() and again_ends.tolist() == ends.tolist()


def test_room_is_made_for_new_pieces(tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "PIECES", 40)
    monkeypatch.setattr(tf, "SHORT", 12)
    encoder = tf.Encoder(None, 1, True)
    for i in range(30):
        texts = [f"Often, often! often w{i}rd{'abcdefghij'[i % 10] * 3} 日本{i}", "x" * 5000 + f" x{'y' * (i + 20)}", " ".join(f"b{chr(97 + (i + j) % 26)}" for j in range(9))]
        ids, ends = encoder(pa.array(texts))
        for t, a, b in zip(texts, [0, *ends], ends):
            assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t
        assert len(encoder.known) == len(encoder.at) == len(encoder.used) + 1 <= 60
    assert "often" in encoder.known and "x" * 5000 in encoder.known


def test_remembered_runs_are_not_taken_apart_again(tokenizer, monkeypatch):
    texts = pa.array(["Often, often seen", "", " Seen!  often\n", "日本語 x" + "y" * 100])
    encoder = tf.Encoder(None, 1, True)
    asked = []
    monkeypatch.setattr(encoder, "runs", lambda words, others, real=encoder.runs: asked.append(words.to_pylist() + others) or real(words, others))
    first, first_ends = encoder(texts)
    ids, ends = encoder(texts)
    assert sorted(asked[0]) == sorted(["Often,", "often", "seen", "", "Seen!", "日本語", "x" + "y" * 100])
    assert asked[1] == ["x" + "y" * 100]  # long ones are not remembered
    assert ids.tolist() == first.tolist() and ends.tolist() == first_ends.tolist()
    for t, a, b in zip(texts.to_pylist(), [0, *ends], ends):
        assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t


def test_few_runs_are_remembered_those_met_most(tokenizer, monkeypatch):
    monkeypatch.setattr(tf, "RUNS", 10)
    encoder = tf.Encoder(None, 1, True)
    for i in range(20):
        texts = ["one two one two one two", " ".join(f"w{i}x{j}!" for j in range(i % 14)), "日本 " * (i % 3)]
        ids, ends = encoder(pa.array(texts))
        for t, a, b in zip(texts, [0, *ends], ends):
            assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids + [1], t
        names, kept, sizes, used = encoder.remembered
        assert len(names) == len(sizes) == len(used) <= 10 and sizes.sum() == len(kept)
        assert {"one", "two"} <= set(names.to_pylist())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=14))
def test_pairs_replaced_are_more_frequent_than_those_they_overlap(count):
    want, at = [], 0
    for n in count:  # n: the count of the pair at this place
        if not want or n != want[-1][1]:
            want.append((at, n))
        at += 1
    ends = [s for s, _ in want[1:]] + [at]
    around = [-1, *(n for _, n in want), -1]
    picked = [p for k, ((s, n), e) in enumerate(zip(want, ends)) if n > max(0, around[k], around[k + 2]) for p in range(s, e, 2)]
    assert tf.chosen(np.array(count, np.int32)).tolist() == picked


def test_a_large_batch_is_encoded_in_little_memory():
    words = np.array([f"w{i:x}" for i in range(2000)])
    rng = np.random.default_rng(1)
    batch = pa.RecordBatch.from_pydict({"text": [" ".join(words[rng.integers(0, 2000, 400)]) for _ in range(8000)]})
    encoder = tf.Encoder(None, 1, True)
    tracemalloc.start()
    try:
        n = [len(encoder(some.column("text"))[1]) for some in tf.pieces(batch, tf.CHARS)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(n) == 8000 and batch.nbytes > 14e6 and peak < 100e6


def test_written_and_read_back(spark, tokenizer, tmp_path):
    rows = [(i, ODD[i % len(ODD)]) for i in range(40)] + [(100, "one two three four " * 300), (101, "one two three " * 200)]
    rows += [(7, ODD[4]), (7, ODD[4]), (None, "no id"), (None, None)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, part int").repartition(5)
    path = str(tmp_path / "files")
    tf.write(df, path, shard=200, least=2)
    shards = tf.read(spark, path)
    got = [tuple(r) for r in tf.documents(shards).select("id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()]
    assert [g[0] for g in got] == sorted((i for i, _ in rows if i is not None)) + [None, None]
    # rows of one id may come in either order: their starts follow the files' order
    byid = {}
    for g in plain(tokenizer, rows):
        byid.setdefault(g[0], []).append((g[2], g[3]))
    at = 0
    for i, start, n, crc in got:
        assert start == at and (n, crc) in byid[i]
        byid[i].remove((n, crc))
        at += n
    assert shards.count() > 8 and shards.agg({"n_tokens": "max"}).first()[0] < 200 + 5002
    # random access
    whole = []
    for i, t in sorted(((i, t) for i, t in rows if i is not None and i < 100 and i != 7), key=lambda r: r[0])[:7]:
        whole += tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
    part = tf.token_range(shards, 3, len(whole) - 2).orderBy("place").collect()
    assert [r.place for r in part] == list(range(3, len(whole) - 2)) and [r.token for r in part] == whole[3:-2]


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    tf.write(spark.createDataFrame([], "doc_id long, text string"), path)
    assert tf.documents(tf.read(spark, path)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=60), min_size=1, max_size=6))
def test_grammar_round_trip(docs):
    ids = np.array([x for d in docs for x in d], np.int64)
    ends = np.cumsum([len(d) for d in docs])
    symbols, rules, spans, symbol_ends = tf.compress(ids, ends, 5, least=2)
    row = {"base": 5, "n_tokens": len(ids), "docs": list(range(len(docs))), "rules": tf.packed(rules.ravel()), "spans": tf.packed(spans),
           "symbols": tf.packed(symbols), "ends": tf.packed(symbol_ends)}
    shard = tf.Shard(row)
    assert shard.tokens(0, len(ids)).tolist() == ids.tolist()
    assert shard.bounds().tolist() == [0, *ends]
    for a in range(0, len(ids), 7):
        assert shard.tokens(a, a + 9).tolist() == ids[a:a + 9].tolist()
    for k, (left, right) in enumerate(rules):  # every rule is older symbols, its span theirs
        assert left < 5 + k and right < 5 + k
        assert spans[k] == sum(1 if x < 5 else spans[x - 5] for x in (left, right))


def test_repeats_compress():
    ids = np.tile(np.arange(64), 500)
    symbols, rules, _, _ = tf.compress(ids, np.array([len(ids)]), 64)
    assert len(symbols) + 2 * len(rules) < len(ids) / 50
    zeros = np.zeros(4096, np.int64)
    symbols, rules, _, _ = tf.compress(zeros, np.array([4096]), 1)
    assert len(symbols) + 2 * len(rules) < 64


def test_wide_symbols_survive_packing():
    for x in (np.array([], np.int64), np.array([0, 65535]), np.array([65536, 1]), np.array([1 << 40])):
        assert tf.unpacked(tf.packed(x)).tolist() == x.tolist()
