"""Language by rank-order profiles: the most frequent letter n-grams of a text against those of each language."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldspring.llm import textkit

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageConfig:
    grams: int = 300            # length of a profile, and what a missing n-gram costs
    longest: int = 3            # letters of an n-gram; a word is framed by one boundary mark on each side
    most_languages: int = 5000  # more labels than this are taken for an error
    flush: int = 1 << 20        # distinct n-grams a training task holds before it sends its counts


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


_IS_LETTER = None
_NO_LETTER = re.compile(r"[\W\d_]")


def gram_codes(text: str, longest: int) -> np.ndarray:
    """The n-grams of a text as numbers: lower-cased letters, everything else is a word boundary (0)."""
    global _IS_LETTER
    if _IS_LETTER is None:
        _IS_LETTER = _letters()
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    points = np.where(_IS_LETTER[np.minimum(points, 0x10FFFF)], points, 0).astype(np.uint64)
    keep = (points != 0) | np.append(True, points[:-1] != 0)   # one boundary between words
    points = points[keep]
    if not points.any():
        return np.empty(0, dtype=np.uint64)
    out = [points[points != 0]]
    code = points
    for n in range(2, longest + 1):
        code = (code[:-1] << np.uint64(21)) | points[n - 1:]
        # a boundary may stand at either end, not inside
        inner = np.ones(len(code), dtype=bool)
        for k in range(1, n - 1):
            inner &= points[k:len(points) - n + 1 + k] != 0
        out.append(code[inner])
    return np.concatenate(out)


def ranked(codes: np.ndarray, grams: int) -> np.ndarray:
    """The most frequent codes, ties by code."""
    value, count = np.unique(codes, return_counts=True)
    if len(value) > grams:
        least = np.partition(count, len(count) - grams)[len(count) - grams]
        value, count = value[count >= least], count[count >= least]
    return value[np.argsort(-count, kind="stable")][:grams]


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of ``textkit.PIECE`` characters or more, cut where a word ends, so that their n-grams are those of the text.
    Lower-cased first, as that looks beyond a cut."""
    text, at = text.lower(), 0
    while at < len(text):
        seam = _NO_LETTER.search(text, at + textkit.PIECE)
        end = seam.start() if seam else len(text)
        yield text[at:end]
        at = end


def _count(config: LanguageConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def send():
            for lang, parts in held.items():
                value, count = _joined(parts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(value), pa.string()), pa.array(value.view(np.int64)), pa.array(count, pa.int64())],
                                                 names=["_lang", "_gram", "_n"])
        for batch in batches:
            for lang, text in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist()):
                if not text:
                    continue
                parts = held.setdefault(lang, [])
                for piece in _pieces(text):
                    parts.append(np.unique(gram_codes(piece, config.longest), return_counts=True))
                if len(parts) >= 200:
                    held[lang] = [_joined(parts)]
                    size = sum(len(p[0]) for ps in held.values() for p in ps)
            if size > config.flush:
                yield from send()
                held, size = {}, 0
        yield from send()
    return run


def _joined(parts: list) -> tuple[np.ndarray, np.ndarray]:
    value, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return value, np.bincount(where, weights=np.concatenate([p[1] for p in parts]), minlength=len(value)).astype(np.int64)


@dataclass
class Profiles:
    """Languages, the codes that any of them has, and the rank of each code in each language."""
    languages: list[str]
    codes: np.ndarray
    ranks: np.ndarray

    @classmethod
    def of(cls, lists: dict[str, list[int]], grams: int) -> "Profiles":
        languages = sorted(lists)
        codes = np.unique(np.array([c for v in lists.values() for c in v], dtype=np.int64).view(np.uint64))
        ranks = np.full((len(codes), len(languages)), grams, dtype=np.int32)
        for column, lang in enumerate(languages):
            own = np.array(lists[lang], dtype=np.int64).view(np.uint64)
            ranks[np.searchsorted(codes, own), column] = np.arange(len(own))
        return cls(languages, codes, ranks)

    def predict(self, text: str | None, config: LanguageConfig) -> tuple[str, float]:
        codes = gram_codes(text, config.longest) if text else np.empty(0, dtype=np.uint64)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(codes, config.grams)
        place = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[place] == own
        rank = np.where(known[:, None], self.ranks[place], config.grams)
        missing = rank == config.grams
        distance = np.where(missing, config.grams, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(distance))
        if len(self.languages) == 1:
            return self.languages[0], 1.0 - float(distance[0]) / (config.grams * len(own))
        second = int(np.partition(distance, 1)[1])
        total = second + int(distance[best])
        return self.languages[best], second / total if total else 0.5


def learn_profiles(docs: DataFrame, config: LanguageConfig = LanguageConfig(), text_col: str = "text", lang_col: str = "lang") -> Profiles:
    """The ``grams`` most frequent n-grams of each language over all of ``docs``, ties by code. Rows without text or language
    are left out."""
    rows = docs.select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text")).filter("_lang is not null and _text is not null")
    counts = rows.mapInArrow(_count(config), "_lang string, _gram long, _n long").groupBy("_lang", "_gram").agg(F.sum("_n").alias("_n"))
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.desc("_n"), "_gram"))
    best = counts.withColumn("_rank", rank).filter(F.col("_rank") <= config.grams)
    found = best.limit(config.most_languages * config.grams + 1).collect()
    if len(found) > config.most_languages * config.grams:
        raise ValueError(f"more than {config.most_languages} languages in {lang_col}")
    lists: dict[str, list] = {}
    for row in sorted(found, key=lambda r: (r["_lang"], r["_rank"])):
        lists.setdefault(row["_lang"], []).append(row["_gram"])
    return Profiles.of(lists, config.grams)


def identify(docs: DataFrame, profiles: Profiles, config: LanguageConfig = LanguageConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, lang_pred, score) per row of ``docs``: the language whose profile is least out of place, ties by
    name; score is the second least distance as a share of the two least together (0.5: a tie), for a single
    language its closeness. ``und`` with score 0 for null texts, texts without a letter, and without any profile.
    Only the id and text columns are read; whole texts count; ids may be null or repeat. An empty table gives an empty table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(text, config) for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             names=["_id", "lang_pred", "score"])
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "_id long, lang_pred string, score double").withColumnRenamed("_id", id_col)
