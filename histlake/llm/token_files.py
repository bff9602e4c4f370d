"""Token-ID output: Re-Pair compressed shards with random access.

Documents are dealt by ranges of their id, so the files hold them in ascending
order.  A task encodes its documents and closes a shard whenever it holds
``SHARD`` ids; a document is never cut, so a shard is at most ``SHARD`` ids and
one document long.  A shard is one row of Parquet:

* ``part``, ``shard``     its place in the order of all shards;
* ``n_tokens``, ``within``  ids in the shard, and in the part's shards before it;
* ``base``                the first nonterminal: ids below it are tokens;
* ``rules``               pairs of symbols, one pair a nonterminal;
* ``spans``               how many ids each nonterminal expands to;
* ``symbols``             the compressed sequence;
* ``docs``, ``ends``      the documents and, for each, the symbols up to its end.

Re-Pair replaces the most frequent pair of neighbours by a nonterminal, again and
again.  Here a round takes every pair that is more frequent than the pairs it
overlaps, which cannot disturb each other, and rounds go on while a pair occurs
``LEAST`` times.  Pairs never cross the end of a document, so each document is a
whole number of symbols; with the spans, any range of ids is found and decoded
without expanding the rest.

Encoding: a text is the sequence of its words' ids, and the tokenizer's library encodes
every distinct word once (see ``Encoder``).  That equals encoding the text as a whole
for a tokenizer that lower-cases, drops white space and cuts words as this one does;
``parted=False`` encodes whole texts, for others.

A null text is empty; an empty text is only its end id.  Rows with a null id come
last.  Rows that share an id go by their text's hash, then by text.  Very long texts
are one document in one shard.  An empty table has no shards.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histlake.llm.common import cut

#: Ids after which a shard closes; least occurrences of a pair that is replaced, least
#: replacements that are worth a rule, share of the symbols that a round has to save for
#: another one, and bits of the hash that pairs are counted by.
SHARD, LEAST, WORTH, GAIN, SLOT_BITS = 1 << 18, 8, 3, 0.01, 19
#: Bytes of text encoded at a time (which takes 15 to 60 times that in memory), distinct pieces
#: that a Python worker remembers, characters of all those, and of those that it remembers
#: longest.
CHARS, PIECES, LETTERS, SHORT = 1 << 22, 1 << 19, 1 << 24, 64
#: Runs between white space that a Python worker remembers as a whole, and the number of a piece
#: that it does not know.
RUNS, MISSING = 1 << 17, -2

SCHEMA = ("part int, shard int, n_tokens bigint, within bigint, base int, rules binary, spans binary, symbols binary, "
          "docs array<bigint>, ends binary")


# --- grammar -----------------------------------------------------------------

def chosen(count: np.ndarray) -> np.ndarray:
    """Places to replace, ascending: pairs more frequent than both neighbours; in a run of
    equally frequent ones every second."""
    above = count[1:] > count[:-1]
    level = count[1:] == count[:-1]
    pick = count > 0
    pick[1:] &= above
    pick[:-1] &= count[:-1] > count[1:]
    level &= count[1:] > 0
    # runs of equally frequent ones, which are few: where each starts and ends
    inside = np.flatnonzero(level)
    if len(inside):
        new = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
        first, last = inside[new], inside[np.append(new[1:], len(inside)) - 1] + 1
        peak = np.ones(len(first), bool)
        peak[first > 0] = above[first[first > 0] - 1]
        after = last < len(count) - 1
        peak[after] &= count[last[after]] > count[last[after] + 1]
        first, last = first[peak], last[peak]
        pick[places(first, (last - first) // 2 + 1, 2)] = True
    return np.flatnonzero(pick)


def compress(ids: np.ndarray, ends: np.ndarray, base: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, spans, ends): ``ids`` by a grammar whose pairs do not cross ``ends``.

    Pairs are counted by a hash of theirs; where two share a hash, both look as frequent
    as both together.  What is replaced is counted exactly: a rule is used ``WORTH`` times or more."""
    seq = ids.astype(np.uint32)
    doc_end = np.zeros(len(seq), bool)
    doc_end[ends - 1] = True
    rules, spans, n_rules = [], np.ones(base, np.int64), 0
    while len(seq) > 1:
        a, b = seq[:-1], seq[1:]
        slot = ((a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B))) >> np.uint32(32 - SLOT_BITS)
        slot[doc_end[:-1]] = 1 << SLOT_BITS
        slot = slot.astype(np.intp)
        often = np.bincount(slot, minlength=(1 << SLOT_BITS) + 1)
        often[-1] = 0
        often = often.astype(np.int32)[slot]
        often *= often >= least
        at = chosen(often)
        kinds, which, used = np.unique((a[at].astype(np.int64) << 32) | b[at], return_inverse=True, return_counts=True)
        worth = used >= WORTH
        if not worth.any():
            break
        keep = worth[which]
        at, which = at[keep], which[keep]
        number = np.cumsum(worth) - 1 + base + n_rules
        left, right = kinds[worth] >> 32, kinds[worth] & 0xFFFFFFFF
        rules.append(np.stack([left, right], 1))
        spans = np.concatenate([spans, spans[left] + spans[right]])
        n_rules += len(left)
        seq[at] = number[which]
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        doc_end[at] = doc_end[at + 1]
        enough = len(at) < GAIN * len(seq)
        stay = np.flatnonzero(stay)
        seq, doc_end = seq[stay], doc_end[stay]
        if enough:
            break
    found = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return seq.astype(np.int64), found, spans[base:], np.flatnonzero(doc_end) + 1


def places(starts: np.ndarray, sizes: np.ndarray, step: int = 1) -> np.ndarray:
    """start, start + step, ... of each size, one after the other."""
    total = int(sizes.sum())
    kind = np.int32 if max(total, int(starts.max(initial=0))) < 1 << 29 else np.int64
    out = np.repeat((starts - step * (np.cumsum(sizes) - sizes)).astype(kind), sizes)
    out += np.arange(0, step * total, step, dtype=kind)
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, spans: np.ndarray, base: int) -> np.ndarray:
    """The ids that ``symbols`` stand for: the rules they use are expanded once each, side by
    side, then looked up."""
    at_rule = np.flatnonzero(symbols >= base)
    rule = symbols[at_rule] - base
    is_used = np.zeros(len(rules), bool)
    is_used[rule] = True
    used = np.flatnonzero(is_used) + base
    flat = used
    while (deep := flat >= base).any():
        at = np.cumsum(1 + deep) - 1 - deep
        out = np.empty(len(flat) + int(deep.sum()), np.int64)
        pairs = rules[flat[deep] - base]
        out[at[~deep]], out[at[deep]], out[at[deep] + 1] = flat[~deep], pairs[:, 0], pairs[:, 1]
        flat = out
    # a table of every token by itself would be as long as the vocabulary: tokens are looked up in place
    ends = np.cumsum(spans[used - base])
    of_rule = np.zeros(len(rules), np.int64)
    of_rule[used - base] = ends - spans[used - base]
    sizes, starts = np.ones(len(symbols), np.int64), len(flat) + np.arange(len(symbols))
    sizes[at_rule], starts[at_rule] = spans[rule], of_rule[rule]
    return np.concatenate([flat, symbols])[places(starts, sizes)]


def packed(x: np.ndarray) -> bytes:
    """One byte for the width (2, 4 or 8), then little-endian unsigned integers."""
    width = 2 if (top := int(x.max(initial=0))) < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + x.astype(f"<u{width}").tobytes()


def unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(x, f"<u{x[0]}", offset=1).astype(np.int64)


class Shard:
    """A shard that has been read; decodes documents or any range of its ids."""

    def __init__(self, row: dict):
        self.base, self.n_tokens, self.docs = row["base"], row["n_tokens"], row["docs"]
        self.rules = unpacked(row["rules"]).reshape(-1, 2)
        self.symbols, self.ends = unpacked(row["symbols"]), unpacked(row["ends"])
        self.spans = unpacked(row["spans"])
        deep = self.symbols >= self.base
        sizes = np.ones(len(self.symbols), np.int64)
        sizes[deep] = self.spans[self.symbols[deep] - self.base]
        self.places = np.concatenate([[0], np.cumsum(sizes)])  # of each symbol's first id

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` up to ``stop``; only the symbols that hold them are expanded."""
        start, stop = max(start, 0), min(stop, self.n_tokens)
        if start >= stop:
            return np.zeros(0, np.int64)
        first, last = np.searchsorted(self.places, [start, stop - 1], side="right") - 1
        ids = expand(self.symbols[first:last + 1], self.rules, self.spans, self.base)
        return ids[start - self.places[first]:stop - self.places[first]]

    def bounds(self) -> np.ndarray:
        """Where each document starts among the shard's ids, and the last one's end."""
        return np.concatenate([[0], self.places[self.ends]])


# --- encoding ----------------------------------------------------------------

#: Characters whose tokens are known to end where their kind changes: printable ASCII and
#: the letters of Latin-1 (one lower case each, no composition), and the runs so made.
_OTHER = re.compile(r"[^\n!-~À-ÖØ-öø-ÿ]|<\|")
_PIECE = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-z0-9ß-öø-ÿ]+")
#: Most runs are a word and the signs that close it, so two pieces at most, which Arrow finds.
_CLOSING = '.,;:!?)"'
_WORD = f"^[A-Za-zÀ-ÖØ-öø-ÿ]+[{_CLOSING}]*$"
_LETTERS = "".join(chr(c) for c in (*range(ord("a"), ord("z") + 1), *range(0xDF, 0x100)) if c != 0xF7)


class Runs(NamedTuple):
    """Runs, the ids of all, how many each has and how often it was met."""
    names: pa.Array
    ids: np.ndarray
    sizes: np.ndarray
    used: np.ndarray


NOTHING = Runs(pa.array([], pa.string()), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64))


def most_used(names: pa.Array, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, used: np.ndarray) -> Runs:
    """The short runs, at most ``RUNS`` of them, those met most; if there are more, earlier ones count half."""
    keep = np.flatnonzero(np.asarray(pc.less_equal(pc.binary_length(names), SHORT)))
    if len(keep) > RUNS:
        keep = np.sort(keep[np.argpartition(-used[keep], RUNS)[:RUNS]])
        used = used // 2
    elif len(keep) == len(names):
        return Runs(names, ids, sizes, used)
    return Runs(names.take(pa.array(keep)), ids[places(starts[keep], sizes[keep])], sizes[keep], used[keep])


class Encoder:
    """A tokenizer file, with the ids of the pieces it has already encoded, and of the runs
    between white space that were met most, which need not be taken apart again.

    A piece is what the tokenizer itself treats as one word (``_PIECE``, after lower-casing);
    distinct ones are encoded once, many to a text, and told apart by the mark that
    the last token of a word carries.  Runs with other characters, or with the string
    of a special token, are pieces as they are."""

    def __init__(self, file: str | None, end: int, parted: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has one task a core already
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(file or default_file())
        self.bare = Tokenizer(self.tokenizer.model)  # for pieces, which need no more cutting or lower-casing
        self.bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values(), default=0) + 1
        mark = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.last = np.zeros(self.size, bool)
        self.last[[i for t, i in vocabulary.items() if mark and t.endswith(mark)]] = True
        self.end, self.parted, self.marked = end, parted, bool(mark)
        self.known, self.ids, self.at, self.used, self.chars = {"\n": -1}, np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, np.int64), 1
        self.remembered = NOTHING

    def forget(self) -> None:
        """Makes room: the short pieces that were looked up most, and more than once, stay.  No run
        does, so that the next look-ups show which pieces are still in use."""
        self.remembered = NOTHING
        short = np.fromiter(map(len, self.known), np.int64, len(self.known))[1:] <= SHORT  # in the order of their numbers
        often = np.flatnonzero(short & (self.used > 1))
        keep = np.sort(often[np.argsort(-self.used[often], kind="stable")[:PIECES // 2]])
        names, sizes = list(self.known)[1:], np.diff(self.at)[keep]
        self.ids, self.at = self.ids[places(self.at[keep], sizes)], np.concatenate([[0], np.cumsum(sizes)])
        self.used = self.used[keep] // 2
        self.known = {"\n": -1, **{names[k]: i for i, k in enumerate(keep.tolist())}}
        self.chars = sum(map(len, self.known))

    def learn(self, pieces: list[str], odd: list[str]) -> None:
        """Encodes new pieces; ``odd`` ones by themselves."""
        ids, _ = encoded(self.bare, [" ".join(pieces[i:i + 64]) for i in range(0, len(pieces), 64)])
        sizes = np.diff(np.flatnonzero(self.last[ids]) + 1, prepend=0)
        if len(sizes) != len(pieces):
            ids, sizes = encoded(self.tokenizer, pieces)
        odd_ids, odd_sizes = encoded(self.tokenizer, odd)
        first, names = len(self.at) - 1, [*pieces, *odd]
        self.ids = np.concatenate([self.ids, ids, odd_ids])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate([sizes, odd_sizes]))])
        self.used = np.concatenate([self.used, np.zeros(len(names), np.int64)])
        self.known.update(zip(names, range(first, first + len(names))))
        self.chars += sum(map(len, names))

    def look_up(self, pieces: list[str]) -> tuple[np.ndarray, list[str]]:
        """The number of every piece, ``MISSING`` for those not known, and these, each once."""
        number = np.fromiter(map(self.known.get, pieces, repeat(MISSING)), np.int64, len(pieces))
        return number, list(dict.fromkeys(pieces[i] for i in np.flatnonzero(number == MISSING).tolist()))

    def numbers(self, pieces: list[str], odd: list[str]) -> np.ndarray:
        """The number of every piece; new ones are learnt, and so are new odd ones."""
        number, new = self.look_up(pieces)
        if len(self.known) + len(new) + len(odd) > PIECES or self.chars > LETTERS:
            self.forget()
            number, new = self.look_up(pieces)
        known = self.known
        self.learn(new, [r for r in dict.fromkeys(odd) if r not in known])
        if new:
            late = np.flatnonzero(number == MISSING)
            number[late] = [known[pieces[i]] for i in late.tolist()]
        return number

    def runs(self, words: pa.Array, others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all runs, and how many each has: of those that are words (``_WORD``), then of others."""
        lower = pc.utf8_lower(words)
        stems = pc.utf8_rtrim(lower, characters=_CLOSING).dictionary_encode()
        tails = pc.utf8_ltrim(lower, characters=_LETTERS).dictionary_encode()
        stem, tail = strings(stems.dictionary), strings(tails.dictionary)
        joined = "\n".join(others)
        if self.marked and not _OTHER.search(joined):
            plain, odd = np.ones(len(others), bool), []
        else:
            plain = np.array([self.marked and not _OTHER.search(r) for r in others], bool)
            odd = [r for r, p in zip(others, plain) if not p]
            joined = "\n".join(r for r, p in zip(others, plain) if p)
        # no tail is no piece; it is looked up as a line's end, which has no ids
        number = self.numbers([*stem, *(t or "\n" for t in tail), *_PIECE.findall(joined.lower())], odd)
        pair = np.stack([number[:len(stem)][np.asarray(stems.indices)], number[len(stem):len(stem) + len(tail)][np.asarray(tails.indices)]], 1).ravel()
        number = number[len(stem) + len(tail):]
        # the pieces of every run; odd runs are one piece
        breaks = number < 0
        run = np.flatnonzero(plain)[np.cumsum(breaks)[~breaks]] if plain.any() else np.zeros(0, np.int64)
        number = number[~breaks]
        if odd:
            run = np.concatenate([run, np.flatnonzero(~plain)])
            number = np.concatenate([number, np.array([self.known[r] for r in odd], np.int64)])
            order = np.argsort(run, kind="stable")
            run, number = run[order], number[order]
        run = np.concatenate([np.flatnonzero(pair >= 0) // 2, run + len(words)])
        number = np.concatenate([pair[pair >= 0], number])
        self.used += np.bincount(number, minlength=len(self.used))
        sizes = self.at[number + 1] - self.at[number]
        return self.ids[places(self.at[number], sizes)], np.bincount(run, sizes, len(words) + len(others)).astype(np.int64)

    def numbered(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of remembered and new runs, where each run's start, how many they are, and
        which run every word is."""
        before = self.remembered
        known = before.names.cast(words.type)
        at = pc.index_in(words, value_set=known)
        new = at.is_null()
        coded = words.filter(new).dictionary_encode()
        at, new = np.array(at.fill_null(0)), np.asarray(new)
        is_word = pc.match_substring_regex(coded.dictionary, _WORD) if self.marked else pa.array(np.zeros(len(coded.dictionary), bool))
        words, others = coded.dictionary.filter(is_word), coded.dictionary.filter(pc.invert(is_word))
        is_word = np.asarray(is_word)
        place = np.where(is_word, np.cumsum(is_word) - 1, len(words) + np.cumsum(~is_word) - 1).astype(np.int32)
        at[new] = place[np.asarray(coded.indices)] + len(known)
        ids, sizes = self.runs(words, strings(others))
        names = pa.concat_arrays([known, words, others])
        ids, sizes = np.concatenate([before.ids, ids]), np.concatenate([before.sizes, sizes])
        starts = np.cumsum(sizes) - sizes
        if self.remembered is before:  # else room was made
            used = np.bincount(at, minlength=len(names))
            used[:len(before.used)] += before.used
            self.remembered = most_used(names, ids, starts, sizes, used)
        return ids, starts, sizes, at

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and where each text ends."""
        if self.parted:
            words = pc.ascii_split_whitespace(texts)
            # leading and trailing white space leave empty runs, which have no ids
            per_text = np.asarray(words.value_lengths(), dtype=np.int64)
            ids, starts, sizes, at = self.numbered(words.flatten())
            # the end id is a run of its own, after each text's
            table, starts, sizes = np.append(ids, np.int32(self.end)), np.append(starts, len(ids)), np.append(sizes, 1)
            text_end = np.cumsum(per_text + 1)
            own = np.ones(len(at) + len(texts), bool)
            own[text_end - 1] = False
            run = np.full(len(own), len(sizes) - 1, np.int32)
            run[own] = at
            per_run = sizes[run]
            return table[places(starts[run], per_run)], np.cumsum(per_run)[text_end - 1]
        table, n_ids = encoded(self.tokenizer, texts.to_pylist())
        ends = np.cumsum(n_ids + 1)
        out = np.empty(len(table) + len(texts), np.int32)
        own = np.ones(len(out), bool)
        own[ends - 1] = False
        out[ends - 1], out[own] = self.end, table
        return out, ends


_ENCODERS: dict = {}


def worker_encoder(file: str | None, end: int, parted: bool) -> Encoder:
    """The Python worker's encoder: the tasks that it runs one after the other load the
    tokenizer once and share what was learnt."""
    file = file or default_file()
    key = (file, os.stat(file).st_mtime_ns, end, parted)
    if key not in _ENCODERS:
        _ENCODERS.clear()  # one is enough for a query
        _ENCODERS[key] = Encoder(file, end, parted)
    return _ENCODERS[key]


def strings(x: pa.Array) -> list[str]:
    return x.to_numpy(zero_copy_only=False).tolist()


def encoded(tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, and how many each has."""
    ids = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids))


def default_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# --- files -------------------------------------------------------------------

def pieces(batch: pa.RecordBatch, chars: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``chars`` bytes of text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), dtype=np.int64)
    group = np.cumsum(sizes) // chars
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else []
    for a, b in zip(starts, np.append(starts[1:], len(group))):
        yield batch.slice(a, b - a)


def shard_row(part: int, number: int, within: int, docs: list, ids: np.ndarray, ends: np.ndarray, base: int, least: int) -> dict:
    symbols, rules, spans, symbol_ends = compress(ids, ends, base, least)
    return {"part": part, "shard": number, "n_tokens": len(ids), "within": within, "base": base, "rules": packed(rules.ravel()), "spans": packed(spans),
            "symbols": packed(symbols), "docs": docs, "ends": packed(symbol_ends)}


def write(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", file: str | None = None, end: int = 1,
          parted: bool = True, shard: int = SHARD, least: int = LEAST) -> None:
    """Encodes every text, with the id ``end`` after it, into shards at ``path`` (a new
    folder of the shared storage).  ``file``: the tokenizer's, on every executor."""
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()), ("within", pa.int64()), ("base", pa.int32()), ("rules", pa.binary()),
                        ("spans", pa.binary()), ("symbols", pa.binary()), ("docs", pa.list_(pa.int64())), ("ends", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number, encoder = TaskContext.get().partitionId(), 0, None
        names, kept, size, within = [], [], 0, 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate([k[0] for k in kept])
            ends = np.cumsum(np.concatenate([np.diff(k[1], prepend=0) for k in kept]))
            return pa.RecordBatch.from_pylist([shard_row(part, number, within, names, ids, ends, max(encoder.size, end + 1), least)], schema)

        for batch in batches:
            for some in pieces(batch, CHARS):
                encoder = encoder or worker_encoder(file, end, parted)
                ids, ends = encoder(pc.fill_null(some.column("text"), ""))
                ids_of, at, done = some.column("id").to_pylist(), 0, 0
                while at < len(ends):
                    # as many documents as end before the shard is full, and the one that fills it
                    stop = min(int(np.searchsorted(ends, done + shard - size)) + 1, len(ends))
                    last = int(ends[stop - 1])
                    kept.append((ids[done:last], ends[at:stop] - done))
                    names += ids_of[at:stop]
                    size, at, done = size + last - done, stop, last
                    if size >= shard:
                        yield close()
                        names, kept, size, number, within = [], [], 0, number + 1, within + size
        if kept:
            yield close()

    order = [F.col("id").isNull(), F.col("id"), F.xxhash64("text"), F.col("text")]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order[:3]).sortWithinPartitions(*order)
    dealt.select("id", "text").mapInArrow(encode, SCHEMA).write.parquet(path)


def read(spark, path: str) -> DataFrame:
    """The shards at ``path`` with ``before``, the ids of all shards before each."""
    shards = spark.read.schema(SCHEMA).parquet(path)
    parts = cut(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")))  # a row per range of ids
    earlier = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", earlier.alias("earlier"))
    return shards.join(F.broadcast(parts), "part").withColumn("before", F.col("earlier") + F.col("within")).drop("earlier")


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def documents(shards: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the shards."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                shard = Shard(row)
                data, bounds = shard.tokens(0, shard.n_tokens).astype("<u4"), shard.bounds()
                crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(row["docs"], pa.int64()), pa.array(row["before"] + bounds[:-1]), pa.array(np.diff(bounds)),
                                                  pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(decode, "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_range(shards: DataFrame, start: int, stop: int) -> DataFrame:
    """(place, token): ids ``start`` up to ``stop`` of all, from the shards that hold them."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                a = max(start - row["before"], 0)
                ids = Shard(row).tokens(a, stop - row["before"])
                yield pa.RecordBatch.from_arrays([pa.array(row["before"] + a + np.arange(len(ids))), pa.array(ids)], ["place", "token"])

    held = shards.filter((F.col("before") < stop) & (F.col("before") + F.col("n_tokens") > start))
    return held.mapInArrow(decode, "place bigint, token bigint")
