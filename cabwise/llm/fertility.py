"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback encodes every word. Text that the
vocabulary was made for gives several characters a token, few byte tokens and
a broad mix of tokens; noise in letters or bytes and repetition leave these
bands. Encoding damage does only where it is dense: UTF-8 read as Latin-1 stays in
them for all German and English texts of sf0.1 and most French and Spanish ones,
and so does letter noise in a language without a band of its own. Measured for each document: characters a token, the share of byte
tokens, and the entropy of its tokens in bits. Bands are set per language,
else per script of most of the words. Base rules come first: enough words,
and not too many of them in repeated three-word windows.

All is local to a row: no shuffle, nothing gathered; a slice's distinct words
are encoded once.

Defined results: a null text is an empty one (all counts 0, rejected by the
word count). A null or unknown language falls back to the script. Lines are
compared as they are, and only those with a word count. Columns beside id,
text and language are carried through by :func:`keep_clean` only.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabwise.llm.common import SLICE_BYTES, Words, arrow_map, column, documents, row_sums, ship_code, slices
from cabwise.llm.tokens import sentence_piece, spread, vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3


class Band(NamedTuple):
    """Accepted: min_chars <= characters a token <= max_chars, byte share <=
    max_bytes, min_entropy <= entropy (bits)."""

    min_chars: float
    max_chars: float
    max_bytes: float
    min_entropy: float


#: By language code, then by script. A language's min_chars is under the least of
#: its texts that pass the base rules (sf0.1, check_s and check_h: en 1.77, de 1.77,
#: es 1.69, fr 1.65) and over words of random letters (1.59 at most). Alphabets in the vocabulary run from near
#: one character a token (noise) to whole words; others live on byte tokens.
BANDS: dict[str, Band] = {
    "en": Band(1.70, 8.0, 0.10, 3.0), "de": Band(1.70, 8.0, 0.10, 3.0),
    "fr": Band(1.60, 8.0, 0.10, 3.0), "es": Band(1.64, 8.0, 0.10, 3.0),
    "Latin": Band(1.15, 8.0, 0.20, 3.0), "Cyrillic": Band(1.0, 8.0, 0.20, 3.0),
    "Greek": Band(0.8, 6.0, 0.40, 3.0), "Arabic": Band(0.6, 6.0, 0.50, 2.5), "Hebrew": Band(0.6, 6.0, 0.50, 2.5),
    "Devanagari": Band(0.4, 6.0, 0.80, 2.5), "Thai": Band(0.4, 6.0, 0.80, 2.5), "Hangul": Band(0.3, 4.0, 0.90, 2.5),
    "Han": Band(0.3, 4.0, 0.90, 2.5), "Hiragana": Band(0.3, 4.0, 0.90, 2.5), "Katakana": Band(0.3, 4.0, 0.90, 2.5),
}
SCRIPTS = tuple(x for x in BANDS if len(x) > 2 and x != "Latin")

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")


def n_dup_lines(texts: pa.Array) -> np.ndarray:
    lines = Words(texts, pattern="\n")
    rows = np.repeat(np.arange(len(texts)), lines.counts)
    filled = pc.match_substring_regex(lines.vocabulary, r"[^\x20\x09-\x0D]").to_numpy(zero_copy_only=False)
    own = filled[lines.codes]
    width = max(1, len(lines.vocabulary))
    key = rows[own] * width + lines.codes[own]
    return (np.bincount(rows[own], minlength=len(texts))
            - np.bincount(np.unique(key) // width, minlength=len(texts)))


def n_repeat_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Words in windows that their text holds twice or more."""
    rows = np.repeat(np.arange(len(words.counts)), words.counts)
    covered = np.zeros(len(rows), bool)
    if len(rows) >= window:
        last = len(rows) - window + 1
        key = words.codes[:last].astype(np.int64)
        reach = max(1, len(words.vocabulary))
        for i in range(1, window):
            if int(key.max(initial=0)) + 1 > (2**63 - 1) // reach:
                key = np.unique(key, return_inverse=True)[1]
            key = key * reach + words.codes[i:last + i]
        at = np.flatnonzero(rows[:last] == rows[window - 1:])
        at = at[_in_groups(key[at])[0]]
        if len(at):  # windows that the slice repeats: now within each text
            same = np.unique(key[at], return_inverse=True)[1]
            at = at[_in_groups(rows[at] * (int(same.max()) + 1) + same)[0]]
            for i in range(window):
                covered[at + i] = True
    return row_sums(covered, words.offsets)


def _in_groups(key: np.ndarray) -> tuple[np.ndarray]:
    """Where values stand that occur more than once."""
    order = np.argsort(key)
    ranked = key[order]
    equal = ranked[1:] == ranked[:-1]
    several = np.zeros(len(key), bool)
    several[1:] = equal
    several[:-1] |= equal
    return (order[several],)


def scripts_of(words: Words) -> list[str]:
    """Script of most of each row's words; Latin without any other."""
    n = len(words.counts)
    wide = pc.match_substring_regex(words.vocabulary, r"[^\x{0}-\x{24F}]")
    if not pc.any(wide).as_py():
        return ["Latin"] * n
    counts = []
    for script in SCRIPTS:
        has = pc.match_substring_regex(words.vocabulary, rf"\p{{{script}}}").to_numpy(zero_copy_only=False)
        counts.append(row_sums(has[words.codes].astype(np.int64), words.offsets))
    counts = np.stack(counts)
    most = counts.argmax(axis=0)
    return [SCRIPTS[k] if 2 * counts[k, i] > words.counts[i] else "Latin" for i, k in enumerate(most)]


def measure(texts: pa.Array, langs: pa.Array, path: str) -> dict[str, np.ndarray]:
    """The metrics of each text, ``base_failed`` and ``kept``."""
    words = Words(texts)
    offsets, codes, n = words.offsets, words.codes, words.counts
    out = {"n_words": n, "word_chars": row_sums(words.word_points()[codes], offsets),
           "n_symbols": pc.count_substring_regex(pc.fill_null(texts, ""), r"[#*$%&|<>]").to_numpy(zero_copy_only=False),
           "n_dup_lines": n_dup_lines(texts), "n_repeat_words": n_repeat_words(words)}
    model, cache = sentence_piece(path)
    flat, bounds = cache.encode(words.vocabulary)
    tokens, ends = spread(flat, bounds, codes)
    token_bounds = ends[offsets]
    n_tokens = np.diff(token_bounds)
    is_byte = np.fromiter((model.is_byte(i) for i in range(model.vocab_size())), bool, model.vocab_size())
    n_bytes = row_sums(is_byte[tokens].astype(np.int64), token_bounds)
    rows = np.repeat(np.arange(len(n)), n_tokens)
    pairs, count = np.unique(rows * model.vocab_size() + tokens, return_counts=True)
    weight = np.bincount(pairs // model.vocab_size(), weights=count * np.log2(count), minlength=len(n))
    some = np.maximum(n_tokens, 1)
    out |= {"n_tokens": n_tokens, "chars_per_token": out["word_chars"] / some, "byte_share": n_bytes / some,
            "token_entropy": np.maximum(0.0, np.log2(some) - weight / some)}
    out |= {x: out[x].astype(np.int64) for x in METRICS}
    out["base_failed"] = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
    bands = [BANDS.get(lang) if lang in BANDS and len(lang) == 2 else None for lang in langs.to_pylist()]
    if None in bands:
        bands = [b or BANDS[s] for b, s in zip(bands, scripts_of(words))]
    band = np.array(bands, float).reshape(-1, 4)
    out["kept"] = (~out["base_failed"] & (band[:, 0] <= out["chars_per_token"]) & (out["chars_per_token"] <= band[:, 1])
                   & (out["byte_share"] <= band[:, 2]) & (band[:, 3] <= out["token_entropy"]))
    return out


SCHEMA = (", ".join(f"{x} long" for x in METRICS)
          + ", chars_per_token double, byte_share double, token_entropy double, base_failed boolean, kept boolean")


def quality_metrics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                    vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, metrics, base_failed, kept) for every row."""
    path = vocabulary_path(vocabulary)

    def run(batches):
        for batch in slices(batches):
            out = measure(column(batch, "text"), column(batch, "lang"), path)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(x) for x in out.values())],
                                             names=["doc_id", *out])

    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"),
                      F.col(f"`{lang}`").cast("string").alias("lang"))
    return arrow_map(own, run, "doc_id long, " + SCHEMA)


def keep_clean(docs: DataFrame, text: str = "text", lang: str = "lang", vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows of ``docs`` whose text the rules accept, all columns unchanged."""
    ship_code(docs.sparkSession)
    path = vocabulary_path(vocabulary)

    @F.arrow_udf("boolean")
    def accepted(texts: pa.Array, langs: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts, langs], names=["text", "lang"])
        parts = [measure(x.column(0), x.column(1), path)["kept"] for x in slices(iter([batch]), limit=SLICE_BYTES)]
        return pa.array(np.concatenate([np.zeros(0, bool), *parts]))

    return docs.where(accepted(F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string")))


def op6_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_metrics(documents(spark, sf_dir))
