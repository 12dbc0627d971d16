"""Token ids of many texts by a public tokenizer, one distinct word at a time.

The vocabularies used here never join pieces over ASCII white space, so a
text's ids are its words' ids in a row. A slice's distinct words are encoded
(frequent ones come from a bounded per-process cache) and spread out again.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cabwise.llm.common import Words

#: Words that a process keeps with their ids; others are encoded when met.
CACHED_WORDS = 150_000

# Heads are letters that stand alone in NFC and have one lower-case letter;
# tails are ASCII marks, which the split pattern never joins to a letter.
_MARKS = r"[!-/:-@\[-`{-~]"
_HEAD = "[A-Za-zÀ-ÖØ-öø-ÿ]+"


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file; ``name`` may be a path itself."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordCache:
    """Ids of words: ``encode(words)`` gives flat ids and where each word's end.

    Words met for the first time wait in ``young``, which is emptied when full;
    those met again before that are kept. Words that occur once, most of any
    corpus's, don't take the room of others."""

    def __init__(self, encode_new, most: int = CACHED_WORDS):
        self.encode_new, self.most, self.known, self.young = encode_new, most, {}, {}

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        asked = words.to_pylist()
        found = list(map(self.known.get, asked))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            new = []
            for i in missing:
                raw = self.young.pop(asked[i], None)
                if raw is None:
                    new.append(i)
                else:
                    found[i] = raw
                    if len(self.known) < self.most:
                        self.known[asked[i]] = raw
            if len(self.young) > self.most // 2:
                self.young = {}
            for i, ids in zip(new, self.encode_new([asked[i] for i in new])):
                found[i] = self.young[asked[i]] = array("I", ids).tobytes()
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) >> 2)
        return np.frombuffer(b"".join(found), np.uint32), np.concatenate([[0], ends])


def spread(flat: np.ndarray, bounds: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``flat[bounds[c]:bounds[c+1]]`` for each code in turn, and where each ends."""
    size = (bounds[1:] - bounds[:-1])[codes]
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(bounds[codes] - ends[:-1], size)
    at += np.arange(len(at))
    return flat[at], ends


_CACHES: dict[tuple, object] = {}


def _cached(kind: str, path: str) -> bool:
    """Whether this vocabulary is at hand; if not, the one before it is let go."""
    if (kind, path) in _CACHES:
        return True
    _CACHES.clear()
    return False


def _bpe_cache(path: str) -> WordCache:
    if not _cached("bpe", path):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode_new(words):
            for i in range(0, len(words), 10_000):
                for x in tokenizer.encode_batch_fast(words[i:i + 10_000], add_special_tokens=False):
                    yield x.ids

        _CACHES["bpe", path] = WordCache(encode_new)
    return _CACHES["bpe", path]


def lower_word_ids(vocabulary: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each distinct word by a lower-casing BPE that splits letters from marks.

    A word of plain letters with ASCII marks behind is encoded as its
    lower-cased letters and its marks, which many words share; every other
    word goes to the tokenizer as it is.
    """
    plain = pc.match_substring_regex(vocabulary, f"^{_HEAD}{_MARKS}*$")
    head = pc.if_else(plain, pc.utf8_lower(pc.replace_substring_regex(vocabulary, f"{_MARKS}+$", "")), vocabulary)
    tail = pc.if_else(plain, pc.replace_substring_regex(vocabulary, f"^{_HEAD}", ""), "")
    parts = pa.concat_arrays([head, tail]).dictionary_encode()
    flat, bounds = _bpe_cache(path).encode(parts.dictionary)
    both = parts.indices.to_numpy().reshape(2, -1).T.ravel()
    ids, ends = spread(flat, bounds, both)
    return ids, ends[::2]


def text_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all texts, and where each text's ids start and end."""
    words = Words(texts)
    if not len(words.codes):
        return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
    ids, bounds = lower_word_ids(words.vocabulary, path)
    flat, ends = spread(ids, bounds, words.codes)
    return flat, ends[words.offsets]


def sentence_piece(path: str):
    """The model and its word cache."""
    if not _cached("piece", path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        _CACHES["piece", path] = WordCache(lambda words: model.encode(words, num_threads=1), CACHED_WORDS // 3)
        _CACHES["model", path] = model
    return _CACHES["model", path], _CACHES["piece", path]
