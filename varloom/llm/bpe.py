"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

A text encodes to the one token sequence in which every neighbouring pair of tokens is
compatible, that is, in which no merge across their border would have come first. So each
prefix has exactly one last token: of the vocabulary's tokens that end there, the one that
is compatible with the last token of the prefix before it. Following the last tokens back
from the end gives the ids.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from varloom.llm.common import per_batch, texts_of

#: Distinct words whose ids a worker remembers: those used since as many others were met.
REMEMBERED = 100_000
#: What stands before the first token.
START = (1 << 20) - 1

# How the byte-level vocabularies cut texts into words before the merges.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same cuts where a text has no characters but ASCII and the Latin letters up to U+024F:
# classes that can be listed are found twice as fast.
LATIN, SPACE = "A-Za-zÀ-ÖØ-öø-ɏ", r"\t\n\x0b\x0c\r "
LATIN_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^{SPACE}{LATIN}0-9]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
NOT_LATIN = re.compile(rf"[^\x00-\x7f{LATIN}]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Codec:
    """Vocabulary tables of one tokenizer file: byte-level BPE in the JSON form."""

    def __init__(self, content: str):
        file = json.loads(content)
        model = file["model"]
        vocab, merges = model["vocab"], model["merges"]
        self.letters = byte_letters()
        self.table = {b: c for b, c in enumerate(self.letters)}
        byte_of = {c: b for b, c in enumerate(self.letters)}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of = {i: bytes(map(byte_of.__getitem__, t)) for t, i in vocab.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made_at: dict[int, int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self.rank.setdefault(pair, rank)
            if whole not in self.halves:
                self.halves[whole], self.made_at[whole] = pair, rank
        self.ends = ahocorasick.Automaton()
        for token, i in vocab.items():
            if len(token) == 1 or i in self.halves:
                self.ends.add_word(token, (len(token), i))
        self.ends.make_automaton()
        self.fits: dict[int, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether no merge across the border of two tokens comes before those within them.

        The token at the border is, over time, each of the right parts of ``left`` and left
        parts of ``right``, up to the merge that makes it part of the next larger one. Of
        equal merges the leftmost runs first, so a tie is won by the left token's own merge
        and lost by the right one's.
        """
        never = 1 << 60
        lefts, until = [], never
        while True:
            lefts.append((left, until))
            if left not in self.halves:
                break
            until, left = self.made_at[left], self.halves[left][1]
        until = never
        while True:
            for part, part_until in lefts:
                at = self.rank.get((part, right))
                if at is not None and at < part_until and at <= until:
                    return False
            if right not in self.halves:
                return True
            until, right = self.made_at[right], self.halves[right][0]

    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word, written in byte letters.

        ``last[i]`` is the last token of the prefix up to and with letter i; the empty
        prefix is found at -1. Longer tokens come first among those ending at a letter.
        """
        last, size, known = [None] * len(word) + [START], [0] * len(word), self.fits.get
        for end, (length, token) in self.ends.iter(word):
            if last[end] is None and (left := last[end - length]) is not None:
                fits = known(left << 20 | token)
                if fits is None:
                    fits = self.fits[left << 20 | token] = left == START or self.compatible(left, token)
                if fits:
                    last[end], size[end] = token, length
        ids, at = [], len(word) - 1
        while at >= 0:
            if last[at] is None:
                raise ValueError("the vocabulary lacks a byte of this text")
            ids.append(last[at])
            at -= size[at]
        return tuple(reversed(ids))

    def words_to_ids(self, text: str) -> list[tuple[int, ...]]:
        known, out = self.known, []
        words = WORDS if NOT_LATIN.search(text) else LATIN_WORDS
        for word in words.findall(text):
            ids = known.get(word)
            if ids is None:
                if len(known) >= REMEMBERED:
                    self.before, self.known = known, (known := {})
                if len(self.fits) >= 2 * REMEMBERED:
                    self.fits.clear()
                ids = self.before.get(word)
                if ids is None:
                    ids = self.encode_word(word.encode().decode("latin-1").translate(self.table))
                if len(word) < 64:
                    known[word] = ids
            out.append(ids)
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text; special tokens written in it become their own ids."""
        if self.cut is None or not any(t in text for t in self.special):
            return list(chain.from_iterable(self.words_to_ids(text)))
        ids: list[int] = []
        for part in self.cut.split(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                ids += chain.from_iterable(self.words_to_ids(part))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special ones included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def read_file(path: str) -> str:
    """The tokenizer file, read once on the driver: a vocabulary has a fixed, small size."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def codec_of(holder: dict) -> Codec:
    """The codec of a broadcast file.

    A Python worker keeps the value of a broadcast from task to task, so the tables are
    built, and words remembered, once per worker and not once per task.
    """
    if "codec" not in holder:
        holder["codec"] = Codec(holder["content"])
    return holder["codec"]


class Tokenizer:
    """Column functions of one tokenizer file; tasks get the file with the job."""

    def __init__(self, spark: SparkSession, path: str):
        self.shared = spark.sparkContext.broadcast({"content": read_file(path)})

    def encode(self, text: str) -> Column:
        """array<int> of ids; null texts count as empty and have none."""
        return self._column(text, lambda codec, texts: id_lists([codec.encode(t) for t in texts]), "array<int>")

    def decode(self, ids: str) -> Column:
        """The text of an array of ids; null counts as no ids."""
        shared = self.shared

        def start():
            codec = codec_of(shared.value)
            return lambda batch: pa.array([codec.decode(x.values.to_pylist() if x.is_valid else []) for x in batch])

        return per_batch(start, "string")(F.col(ids))

    def round_trip(self, text: str) -> Column:
        """struct(ids, decoded): a text's ids, and the text that these ids decode to, in one pass."""

        def both(codec: Codec, texts: list[str]) -> pa.Array:
            ids = [codec.encode(t) for t in texts]
            decoded = pa.array([codec.decode(i) for i in ids], pa.string())
            return pa.StructArray.from_arrays([id_lists(ids), decoded], ["ids", "decoded"])

        return self._column(text, both, "ids array<int>, decoded string")

    def _column(self, text: str, work_on, returns: str) -> Column:
        shared = self.shared

        def start():
            codec = codec_of(shared.value)
            return lambda batch: work_on(codec, texts_of(batch))

        return per_batch(start, returns)(F.col(text))


def id_lists(rows: list[list[int]]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(offsets[-1]))
    return pa.ListArray.from_arrays(offsets, flat)
