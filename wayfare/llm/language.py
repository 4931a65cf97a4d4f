"""Operator 6: language identification by compression.

Each language gets a zstandard raw-content dictionary cut from a bounded sample of its
labelled texts. A text is compressed in blocks with every dictionary; the language whose
dictionary gives the smallest total wins. The gap to the runner-up, relative to the
runner-up's size, is the margin; a narrow margin rejects the text. Short texts are measured
behind a neutral block, word by word rotated; the shortest are not rejected for a margin.

Defined results: a null text, or one without a letter, is ``und`` with score 0, margin 0
and rejected. Equal sizes go to the language with more training rows, then the smaller
name. Repeated rows each get their own (equal) result. With nothing to learn from, every
text is ``und``. Very long texts are compressed block by block, to the end.
"""

from __future__ import annotations

from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.shared import map_slices

UNDETERMINED = "und"
# The fit reads a bounded sample: at most SAMPLE_SLOTS texts per language, a passage of
# at most SAMPLE_CHARS characters from each, and DICT_BYTES of them per dictionary.
SAMPLE_SLOTS = 64
SAMPLE_CHARS = 2048
DICT_BYTES = 1 << 15
BLOCK_BYTES = 4096
LEVEL = 6
MIN_MARGIN = 0.005
# A text below SHORT_BYTES is measured behind a neutral block, as alone it would be stored
# and not compressed, and in as many rotations of its words as it has, up to SHORT_ROUNDS,
# as one size in whole bytes is coarse.
SHORT_BYTES, SHORT_ROUNDS, NEUTRAL = 256, 16, b"\n" * 400
# Below so many bytes a narrow margin says that the text is short and no more: it is
# rejected only if it has no letter.
JUDGED_BYTES = 64
# Every language's dictionary goes to every task, and every text is compressed with each.
MAX_LANGUAGES = 256


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order of preference at equal sizes, with their dictionaries."""
    languages: tuple[str, ...]
    dictionaries: tuple[bytes, ...]


def fit_language_model(train: DataFrame, key: str, slots: int = SAMPLE_SLOTS, chars: int = SAMPLE_CHARS,
                       dict_bytes: int = DICT_BYTES) -> LanguageModel:
    """Dictionaries from the rows of ``train`` with a text and a lang; ``key`` names the
    column whose hash picks the sample (one row for each language and hash slot). More than
    MAX_LANGUAGES different labels are an error: such a column does not hold languages."""
    labels = train.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang").distinct().limit(MAX_LANGUAGES + 1)
    if labels.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different values of lang")
    rows = (train.filter("text IS NOT NULL AND lang IS NOT NULL")
            .select("lang", "text", F.xxhash64(F.col(key)).alias("h"))
            .withColumn("slot", F.pmod("h", F.lit(slots))))
    picked = rows.groupBy("lang", "slot").agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("n"))
    # At most `slots` rows a language: a bounded side.
    sample = rows.drop("slot").join(F.broadcast(picked.select("lang", "h")), ["lang", "h"])
    room = F.greatest(F.lit(1), F.char_length("text") - chars + 1)
    passage = F.substring("text", (F.pmod(F.xxhash64("text"), room) + 1).cast("int"), F.lit(chars))
    texts: dict[str, list[str]] = {}
    for r in sample.groupBy("lang", "h").agg(F.min(passage).alias("passage")).orderBy("lang", "h").collect():
        texts.setdefault(r["lang"], []).append(r["passage"])
    counts = {r["lang"]: r["n"] for r in picked.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    order = sorted(texts, key=lambda lang: (-counts[lang], lang))
    return LanguageModel(tuple(order), tuple(
        "\n".join(dict.fromkeys(_plain(t) for t in texts[lang])).encode()[:dict_bytes] or b" " for lang in order))


def _plain(text: str) -> str:
    return " ".join(text.lower().split())


def compressors(model: LanguageModel, level: int = LEVEL) -> list[zstandard.ZstdCompressor]:
    out = []
    for data in model.dictionaries:
        zd = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        zd.precompute_compress(level=level)
        out.append(zstandard.ZstdCompressor(level=level, dict_data=zd, write_content_size=False,
                                            write_checksum=False, write_dict_id=False))
    return out


def classify(text: str | None, languages: tuple[str, ...], comps: list, block: int = BLOCK_BYTES):
    """(language, score, margin) of one text."""
    if not languages or text is None or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0, 0.0
    data = _plain(text).encode("utf-8", "replace")
    rounds = 1
    if len(data) < SHORT_BYTES:
        words = data.split(b" ")
        rounds = min(len(words), SHORT_ROUNDS)
        pieces = [NEUTRAL + b" ".join(words[k:] + words[:k]) for k in range(rounds)]
        sizes = [max(1, sum(len(c.compress(p)) for p in pieces) - rounds * len(c.compress(NEUTRAL))) for c in comps]
    else:
        pieces = [data[at:at + block] for at in range(0, len(data), block)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in comps]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = sizes[:best] + sizes[best + 1:]
    second = min(others, default=2 * sizes[best])
    score = 1.0 / (1.0 + sum(2.0 ** -min((s - sizes[best]) / rounds, 1000) for s in others))
    return languages[best], score, (second - sizes[best]) / second


def is_rejected(text: str | None, language: str, margin: float, min_margin: float = MIN_MARGIN) -> bool:
    """Whether no language can be told: no letter, or a narrow margin on enough text."""
    return language == UNDETERMINED or (margin < min_margin and len(_plain(text).encode("utf-8", "replace")) >= JUDGED_BYTES)


def identify_language(docs: DataFrame, model: LanguageModel, columns: list[str],
                      min_margin: float = MIN_MARGIN) -> DataFrame:
    """``columns`` of each row with lang_pred, score, margin and rejected; map-only.
    ``columns`` may not hold the name of a result column."""
    clash = [c for c in columns if c in ("lang_pred", "score", "margin", "rejected", "_text")]
    if clash:
        raise ValueError(f"kept columns clash with result columns: {clash}")
    languages = model.languages

    def make():
        comps = compressors(model)

        def run(part: dict) -> dict:
            got = [classify(t, languages, comps) for t in part["_text"]]
            return {c: part[c] for c in columns} | {
                "lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "margin": [g[2] for g in got],
                "rejected": [is_rejected(t, g[0], g[2], min_margin) for t, g in zip(part["_text"], got)]}
        return run

    kept = docs.select(*columns, F.col("text").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema)
    return map_slices(kept, make, f"{schema}, lang_pred string, score double, margin double, rejected boolean")


def language_query(documents: DataFrame) -> DataFrame:
    """Query ``op6_language_id``: learn on rows whose crc32(doc_id) mod 3 is not 1, predict
    all rows. A null doc_id is neither held out nor learned from."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    rows = documents.select("doc_id", "text", "lang", F.coalesce(fold == 1, F.lit(False)).alias("held_out"))
    model = fit_language_model(rows.filter("doc_id IS NOT NULL AND NOT held_out"), "doc_id")
    return identify_language(rows, model, ["doc_id", "held_out"])
