"""Language of a text by profiles of letter trigrams and common words; deterministic, unknown where nothing tells."""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from ..functions.fingerprint import signed, simhash_of
from ..functions.text import strip_code

COMMON = {
    "en": "the of and to in a is that it was for on are with as be at this have from or by not but what all were when we there can an your which".split(),
    "fr": "le la les de des du et un une est que qui dans pour pas sur au avec par il elle nous vous ce cette sont plus ne se ou mais".split(),
    "de": "der die das und ist in zu den nicht von mit sich des auf für ein eine als auch es an werden aus er hat dass sie nach bei um".split(),
    "es": "el la los las de que y en un una es por con para no se del al lo como más pero sus le ya o este sí porque esta son".split(),
}
SIGNS = {"fr": "éèêàçùœîôâ", "de": "äöüß", "es": "ñíóáúü¿¡"}
_WORDS = re.compile(r"[^\W\d_]+")
_WHOLE = {k: set(v) for k, v in COMMON.items()}


_COMMON_IN: dict[str, tuple[str, ...]] = {w: tuple(k for k, own in _WHOLE.items() if w in own) for w in set().union(*_WHOLE.values())}


def _common_in(word: str) -> tuple[str, ...]:
    return _COMMON_IN.get(word, ())


@lru_cache(maxsize=100_000)
def _signs_of(word: str) -> tuple[str, ...]:
    return tuple(k for k, signs in SIGNS.items() if any(s in word for s in signs))


def detect(text: str | None) -> str:
    words = Counter(_WORDS.findall((text or "").lower()))
    n = sum(words.values())
    if not n:
        return "unknown"
    common, signed = dict.fromkeys(_WHOLE, 0), dict.fromkeys(SIGNS, 0)
    for w, c in words.items():
        for k in _common_in(w):
            common[k] += c
        for k in () if w.isascii() else _signs_of(w):
            signed[k] += c
    score = {k: v / n for k, v in common.items()}
    for k, v in signed.items():
        score[k] += 2.0 * v / n
    best = max(sorted(score), key=score.get)
    return best if score[best] > 0.02 else "unknown"


@pandas_udf(StringType())
def detect_udf(texts):
    return texts.map(detect)


def with_language(df, text_col: str, to: str = "language"):
    """Language of the text without code; the code is stripped in the JVM, before Arrow."""
    return df.withColumn(to, detect_udf(strip_code(F.col(text_col))))


def with_language_and_print(df, text_col: str, which: Column, languages: tuple[str, ...]):
    """df with language of the rows that `which` holds for, and simhash (BLAKE2b) of those in one of the languages; null otherwise.

    Texts go to Python once for both; what is left without code goes beside them only where there is code.
    """
    whole = F.when(which, F.col(text_col))
    code = F.contains(whole, F.lit("`"))

    @F.arrow_udf("struct<language:string,simhash:bigint>")
    def judge(texts: pa.Array, bare: pa.Array) -> pa.Array:
        found, prints = [], []
        for t, b in zip(texts, bare, strict=True):
            text = t.as_py()
            found.append(None if text is None else detect(b.as_py() if b.is_valid else text))
            prints.append(signed(simhash_of(text)) if found[-1] in languages else None)
        return pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(prints, pa.int64())], ["language", "simhash"])

    judged = df.withColumn("__judged", judge(whole, F.when(code, strip_code(whole))))
    return judged.withColumns({"language": F.col("__judged.language"), "simhash": F.col("__judged.simhash")}).drop("__judged")
