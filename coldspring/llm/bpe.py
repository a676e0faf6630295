"""Byte-pair encoding of whole texts with a given merge table, and decoding.

A word is encoded by dynamic programming over its prefixes. Byte-pair encoding gives every prefix exactly one last
token, so one number per prefix is stored: an automaton over all tokens lists those that end at a place, and of them
the one is taken that stands beside the last token of the prefix before it without ever being merged with it. The ids
come out by following these tokens back from the end. The time is proportional to the length, whatever the merges.

Two neighbours are compatible if no merge crosses their border while both are built. Every token is built by merges
of rising rank, so it is enough to look at the symbols that touch the border, undoing the later merge first.

The vocabulary file is read by the driver and broadcast (fixed size, some MB).
"""

from __future__ import annotations

import json
import os
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from coldspring.llm import textkit

CACHED_WORDS = 200_000     # distinct words a task keeps with their ids; then it starts anew
CACHED_LENGTH = 64         # longer words are encoded each time
CACHED_PAIRS = 1_000_000
_NEVER = 1 << 60


@dataclass(frozen=True)
class Merges:
    """A merge table. Symbols 0-255 are bytes, 256-511 bytes that end a word; symbol 512 + r is made by merge r."""
    pattern: str                    # what is a word; all else is dropped
    specials: dict[str, int]        # strings that are tokens of their own, found before anything else
    ids: list[int]                  # symbol -> id of the file
    names: list[str]                # symbol -> string of the file
    left: list[int]
    right: list[int]
    usable: list[bool]              # the symbol's own bytes are encoded as this symbol


def _byte_names() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable Latin-1 characters stand for
    themselves, the others for the characters from 256 on, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    names, extra = {b: chr(b) for b in own}, 256
    for b in range(256):
        if b not in names:
            names[b], extra = chr(extra), extra + 1
    return [names[b] for b in range(256)]


def read_merges(path: str) -> Merges:
    """The merge table of a ``tokenizers`` file whose words end in a marked symbol (BPE over bytes; NFC, lower case; a
    splitting pattern whose matches stay). Files of another kind raise ValueError."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    model, before = data["model"], data["pre_tokenizer"]
    steps = [s["type"] for s in (before or {}).get("pretokenizers", [])]
    forms = [s["type"] for s in (data["normalizer"] or {}).get("normalizers", [])]
    end = model.get("end_of_word_suffix")
    if model["type"] != "BPE" or not end or steps != ["Split", "ByteLevel"] or forms != ["NFC", "Replace", "Lowercase"]:
        raise ValueError(f"{os.path.basename(path)}: not a byte-level BPE with word ends, NFC and lower case")
    if model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or data["decoder"]:
        raise ValueError(f"{os.path.basename(path)}: dropout, byte fallback, whole-word look-up or a decoder")
    names = _byte_names()
    names = names + [n + end for n in names]
    symbol = {n: i for i, n in enumerate(names)}
    left, right = list(range(512)), list(range(512))
    for number, merge in enumerate(model["merges"]):
        a, b = merge if isinstance(merge, list) else merge.split(" ")
        if a + b in symbol or symbol.get(a, _NEVER) >= 512 + number or symbol.get(b, _NEVER) >= 512 + number:
            raise ValueError(f"merge {number} makes a known token or needs an unknown one")
        left.append(symbol[a])
        right.append(symbol[b])
        symbol[a + b] = 512 + number
        names.append(a + b)
    vocabulary = model["vocab"]
    table = Merges(before["pretokenizers"][0]["pattern"]["Regex"], {t["content"]: t["id"] for t in data["added_tokens"]},
                   [vocabulary[n] for n in names], names, left, right, [True] * len(names))
    pairs = _pairs(table)
    for s in range(512, len(names)):
        a, b = left[s], right[s]
        table.usable[s] = table.usable[a] and table.usable[b] and compatible(table, pairs, a, b, s)
    return table


def _pairs(table: Merges) -> dict[tuple[int, int], int]:
    return {(table.left[s], table.right[s]): s for s in range(512, len(table.names))}


def compatible(table: Merges, pairs: dict[tuple[int, int], int], x: int, y: int, before: int = _NEVER) -> bool:
    """Whether the bytes of x and y, side by side, are still x and y when all merges below ``before`` were made.

    Symbol numbers rise with the rank of the merge. The border pair (u, v) merges if that comes before u is used up
    (at the same rank the merge on the left is made first) and not after v is.
    """
    x_used = y_used = before
    while True:
        merge = pairs.get((x, y))
        if merge is not None and merge < x_used and merge <= y_used:
            return False
        if x > y and x >= 512:
            x_used, x = x, table.right[x]
        elif y >= 512:
            y_used, y = y, table.left[y]
        else:
            return True


class _Known(dict):
    """What was found for a key before; computed where it is missing."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, key):
        return self.find(key)


class Encoder:
    """Encodes words and texts; keeps what it found for frequent words."""

    def __init__(self, table: Merges):
        self.table = table
        self.pairs = _pairs(table)
        self.words = regex.compile(table.pattern)
        self.marks = regex.compile("|".join(map(regex.escape, table.specials))) if table.specials else None
        self.automaton = ahocorasick.Automaton()
        self.lengths: list[int] = []
        spelled: list[str] = []
        for s in range(len(table.names)):
            spelled.append(chr(s) if s < 512 else spelled[table.left[s]] + spelled[table.right[s]])
            self.lengths.append(len(spelled[-1]))
            if table.usable[s]:
                self.automaton.add_word(spelled[-1], s)
        self.automaton.make_automaton()
        self.known = _Known(self._word)          # word -> symbols
        self.beside = _Known(self._fits)         # pair of symbols, as one number -> compatible
        self._library = None

    def _fits(self, pair: int) -> bool:
        if len(self.beside) >= CACHED_PAIRS:
            self.beside.clear()
        found = self.beside[pair] = compatible(self.table, self.pairs, *divmod(pair, len(self.table.names)))
        return found

    def symbols(self, word: str) -> list[int]:
        """The symbols of one word."""
        data = word.encode()
        text = data[:-1].decode("latin-1") + chr(256 + data[-1])
        last = [-1] * (len(text) + 1)      # last token of each prefix
        lengths, beside, n = self.lengths, self.beside, len(self.table.names)
        for end, token in self.automaton.iter(text):
            if last[end + 1] < 0:
                start = end + 1 - lengths[token]
                if start == 0 or (last[start] >= 0 and beside[last[start] * n + token]):
                    last[end + 1] = token
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= lengths[last[at]]
        return out[::-1]

    def _word(self, word: str) -> tuple[int, ...]:
        found = tuple(self.symbols(word))
        if len(word) <= CACHED_LENGTH:
            if len(self.known) >= CACHED_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def _split(self, text: str) -> list[str]:
        """Normalised words. White space is never part of a word, so runs of it need not be made one space. Characters
        that the tables of this Python do not know are left to those of the library."""
        if not text.isascii() and any(unicodedata.category(c) == "Cn" for c in set(text)):
            return self._split_by_library(text)
        # the lower-case form of a capital sigma does not depend on its neighbours here
        return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def _split_by_library(self, text: str) -> list[str]:
        if self._library is None:
            from tokenizers import Regex, normalizers, pre_tokenizers
            self._library = (normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]),
                             pre_tokenizers.Split(Regex(self.table.pattern), "removed", invert=True))
        form, split = self._library
        return [word for word, _ in split.pre_tokenize_str(form.normalize_str(text))]

    def encode(self, text: str) -> np.ndarray:
        """The symbols of a text; special strings have the numbers after the last symbol, in the order of the file."""
        found: list[np.ndarray] = []
        at = 0
        marks = self.marks.finditer(text) if self.marks else ()
        order = {name: len(self.table.names) + i for i, name in enumerate(self.table.specials)}
        for mark in chain(marks, [None]):
            piece = text[at:mark.start() if mark else len(text)]
            found.append(np.fromiter(chain.from_iterable(map(self.known.__getitem__, self._split(piece))), dtype=np.int32))
            if mark:
                found.append(np.array([order[mark.group()]], dtype=np.int32))
                at = mark.end()
        return found[0] if len(found) == 1 else np.concatenate(found)


@lru_cache(maxsize=1)
def _encoder(broadcast_id: int, holder) -> Encoder:
    return Encoder(holder.value)


class _Held:
    """A broadcast that is told from others by its number, so that a worker builds its automaton once."""

    def __init__(self, spark: SparkSession, table: Merges):
        self.broadcast = spark.sparkContext.broadcast(table)
        self.number = self.broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"broadcast": self.broadcast, "number": self.number}

    @property
    def value(self) -> Merges:
        return self.broadcast.value

    def __hash__(self):
        return hash(self.number)

    def __eq__(self, other):
        return self.number == other.number


def encode(docs: DataFrame, table: Merges, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``ids`` (array of the ids of its whole text) and ``decoded`` (the tokens as
    strings, joined by one space: what a vocabulary file without a decoder gives back).

    Null and empty texts, and texts of white space only, have no ids and are decoded to "". Rows are independent of
    each other, so repeated ids or texts need no rule; an empty table gives an empty table; other columns are not
    looked at. No shuffle. Memory: one text and some ten times its bytes.
    """
    textkit.small_batches(docs.sparkSession)
    held = _Held(docs.sparkSession, table)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches):
        encoder = _encoder(held.number, held)
        ids = np.array([*table_ids(encoder.table)], dtype=np.int32)
        names = pa.array([*encoder.table.names, *encoder.table.specials], pa.large_string())
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in textkit.pieces([(t or "").encode() for t in texts]):
                symbols = [encoder.encode(t or "") for t in texts[a:b]]
                flat = np.concatenate(symbols)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in symbols])])
                decoded = pa.compute.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), names.take(pa.array(flat))), pa.scalar(" ", pa.large_string()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids[flat])), decoded.cast(pa.string())],
                    ["id", "ids", "decoded"])

    out = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_column)


def table_ids(table: Merges) -> list[int]:
    """The file's id of every symbol, special strings last."""
    return [*table.ids, *table.specials.values()]


def decode(encoded: DataFrame, table: Merges, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded): the tokens of a column of ids as strings, joined by one space. Null ids in a list are left out, a
    null list gives "". An id that the table does not have raises an error."""
    kind = encoded.schema[id_column].dataType.simpleString()
    held = _Held(encoded.sparkSession, table)

    def run(batches):
        merges = held.value
        names = dict(zip(table_ids(merges), [*merges.names, *merges.specials]))
        for batch in batches:
            texts = [" ".join(names[i] for i in ids or () if i is not None) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "decoded"])

    out = encoded.select(encoded[id_column].alias("id"), encoded[ids_column].alias("ids")).mapInArrow(run, f"id {kind}, decoded string")
    return out.withColumnRenamed("id", id_column)
