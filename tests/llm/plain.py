"""Plain versions of the operators' contracts, on lists in memory."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ("size", "piece", "length", "sha", "cls", "h", "key", "n", "band", "mixed", "row", "spans", "kept")
LONG = " ".join(f"w{i % 9973}" for i in range(60_000))

#: (doc_id, text, lang, source): nulls, empty and very long texts, ties, repeated rows.
EDGE = [
    (1, None, "en", "a"), (2, "", None, "a"), (3, " \n\t ", "xx", None), (4, "one", "en", "b"), (5, "One  ", "en", "b"),
    (6, "one two three", "de", "b"), (7, "one two three", "de", "b"), (7, "one two three", "de", "b"),
    (8, LONG, "en", "c"), (9, LONG + " tail", "en", "c"), (None, "a text without an id " * 20, "en", None),
    (None, "a text without an id " * 20, "en", None), (10, "Привет мир " * 40, None, "é"), (11, "\x1c\x85　 x", "", ""),
    (12, "</s>[INST] <|endoftext|> '' \\n", "en", "a"), (13, "l\nl\n\nl\nm", "en", "a"),
    (14, "the quick brown fox jumps over the lazy dog " * 30, "en", "a"),
] + [(100 + i, " ".join(f"p{(i * j) % 101}" for j in range(80)), "en", "a") for i in range(20)]

SCHEMA = "doc_id long, text string, lang string, source string"


def edge_docs(spark):
    """The edge rows, with columns whose names the operators might use themselves."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(EDGE, SCHEMA).repartition(3).withColumns({c: F.lit(c) for c in EXTRA})


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) >= size:
        return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def similar_components(rows, size, percent=80):
    """rows: (id, text); the least id of each row's component, in order."""
    sets = [shingles(t, size) for _, t in rows]
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, n in collections.Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    key = lambda x: (x is None, x)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        least[r] = min(least.get(r, doc), doc, key=key) if r in least else doc
    return [least[find(i)] for i in range(len(rows))]


def without_repeats(rows, window=50):
    """rows: (id, text); (n_words, n_removed, kept text) of each, in order."""
    key = lambda x: float("inf") if x is None else x
    words = [(t or "").encode().split() for _, t in rows]
    codes: dict = {}
    coded = [[codes.setdefault(w, len(codes)) for w in ws] for ws in words]
    first: dict = {}
    for i in sorted(range(len(rows)), key=lambda i: key(rows[i][0])):
        for k in range(len(coded[i]) - window + 1):
            first.setdefault(tuple(coded[i][k:k + window]), key(rows[i][0]))
    out = []
    for i, c in enumerate(coded):
        gone = bytearray(len(c))
        for k in range(len(c) - window + 1):
            if first[tuple(c[k:k + window])] < key(rows[i][0]):
                gone[k:k + window] = b"\1" * window
        out.append((len(c), sum(gone), b" ".join(w for w, g in zip(words[i], gone) if not g).decode()))
    return out


def base_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    thrice = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if thrice[words[i], words[i + 1], words[i + 2]] > 1 for d in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def token_ids(texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in texts]


def pieces(rows, capacity=2048):
    """(doc_id, piece, start, length, ids_crc32) of all rows."""
    out = []
    for (doc, _), ids in zip(rows, token_ids([t for _, t in rows])):
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k:k + capacity], "<u4")
            out.append((doc, k // capacity, k, len(part), zlib.crc32(part.tobytes())))
    return out


def check_packing(rows, capacity=2048):
    """rows: (length, sequence_id, offset). Gapless, and none too long; the number of sequences."""
    by = collections.defaultdict(list)
    for length, sequence, offset in rows:
        by[sequence].append((offset, length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def ppm_log10(train, order, text):
    """Method-C PPM with exclusion, straight from its definition."""
    counts: dict = collections.defaultdict(collections.Counter)
    symbols = lambda t: [255] * order + list((t or "").encode().lower()) + [255]
    for t in train:
        s = symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                counts[tuple(s[i - k:i])][s[i]] += 1
    total, s = 0.0, symbols(text)
    for i in range(order, len(s)):
        seen, p = set(), 1.0
        for k in range(order, -1, -1):
            own = {b: n for b, n in counts.get(tuple(s[i - k:i]), {}).items() if b not in seen}
            if not own:
                continue
            whole = sum(own.values()) + len(own)
            if s[i] in own:
                p *= own[s[i]] / whole
                break
            p *= len(own) / whole
            seen |= set(own)
        else:
            p /= 256 - len(seen)
        total += np.log10(p)
    return total


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
