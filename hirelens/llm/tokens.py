"""Token ids of whole texts by a ``tokenizers`` file, as little-endian bytes.

Every distinct chunk of a text is encoded once per worker and remembered.
Chunks are cut only where the tokenizer itself never joins characters, so the
ids equal those of encoding the text in one call (a test compares them):

* byte-level files split on ``\\s`` runs, so a text may be cut wherever a word
  ends and white space begins; a single space or line feed stays with the word
  after it, longer runs are chunks of their own, cut as the file's own
  pattern cuts them (all but the last character, then the last);
* word-end files drop white space, so a text may be cut at any of it;
* between a letter and a final run of marks, both kinds cut.

Texts with other white space than space, tab, line feed and carriage return,
or with the opening of a special token (``<|`` in these files), are encoded in
one call. A special token's string in a text is that token, as the library has
it, unless ``special_as_text`` is asked for.

The file is read where the job is planned and travels to the workers as bytes
(a few MB); they open no path.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from hirelens.llm.common import process_cache, start_task, text_bytes

#: chunks of a generation that a worker remembers; when it is full, the one
#: before it is forgotten (two generations are some 300 MB)
REMEMBERED = 700_000
LONGEST_CHUNK = 64

#: white space besides _PLAIN_SPACE
_OTHER_SPACE = "[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: new chunks that are encoded as one text
TOGETHER = 1000
#: marks that may be cut off behind a letter (not the apostrophe: contractions)
_ENDS = '.,;:!?&*#%$|)"'
_ENDS_BYTES = _ENDS.encode()
_PLAIN_SPACE = frozenset(" \n\t\r")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x0A, 0x09, 0x0D]] = True
#: those that stay with the word after them
_JOINS = np.zeros(256, bool)
_JOINS[[0x20, 0x0A]] = True


def id_dtype(vocab_size: int) -> np.dtype:
    """The narrowest unsigned type that holds every id."""
    return np.dtype("<u2") if vocab_size <= 1 << 16 else np.dtype("<u4")


def shipped(spark, path: str):
    """(the tokenizer file's bytes, its kind) as a broadcast. The kind is told
    here once: the parsed file is some ten times as large as its bytes."""
    with open(path, "rb") as f:
        blob = f.read()
    return spark.sparkContext.broadcast((blob, kind_of(blob)))


def kind_of(blob: bytes) -> str:
    """How texts may be cut; a file of which some special token does not show by
    its opening allows no cut."""
    spec = json.loads(blob)
    if not all("<|" in t["content"] for t in spec.get("added_tokens", [])):
        return "whole"
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") \
            and not spec.get("normalizer"):
        return "byte"
    parts = pre.get("pretokenizers") or []
    if parts and parts[0].get("type") == "Split" and parts[0].get("invert") \
            and "\\s" in str(parts[0].get("pattern")):
        return "word"
    return "whole"


class Encoder:
    def __init__(self, blob: bytes, special_as_text: bool = False, kind: str | None = None, remembered: int | None = None):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(blob)
        self.tokenizer.encode_special_tokens = special_as_text
        self.dtype = id_dtype(self.tokenizer.get_vocab_size())
        self.kind = kind or kind_of(blob)
        self.remembered = REMEMBERED if remembered is None else remembered
        self.known: dict[bytes, bytes | None] = {}
        self.before: dict[bytes, bytes | None] = {}
        if self.kind == "byte":  # a character of a byte-level token is a byte
            vocab = self.tokenizer.get_vocab()
            self.widths = np.zeros(max(vocab.values()) + 1, np.int64)
            self.widths[list(vocab.values())] = list(map(len, vocab))

    def _plainly(self, texts: list[str]) -> list[bytes]:
        out = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        raw = np.fromiter(chain.from_iterable(out), self.dtype).tobytes()
        at = [0, *accumulate(len(ids) * self.dtype.itemsize for ids in out)]
        return [raw[a:b] for a, b in pairwise(at)]

    def _together(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk of a byte-level file. Those that begin with the
        space before their word are encoded many in one text, and its ids cut by
        the bytes that they stand for."""
        joins = [len(c) > 1 and c[0] in b" \n" and c[1] not in b" \n\t\r" for c in chunks]
        found = [c for c, j in zip(chunks, joins) if j]
        texts = [b"".join(found[k:k + TOGETHER]).decode() for k in range(0, len(found), TOGETHER)]
        out = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(out), self.dtype)
        ends = np.cumsum(self.widths[ids])
        at = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        cut = np.searchsorted(ends, at)
        if len(at) and not (ends[-1] == at[-1] and np.array_equal(ends[cut], at)):
            return self._plainly([c.decode() for c in chunks])
        raw, size = ids.tobytes(), self.dtype.itemsize
        parts = [raw[a:b] for a, b in pairwise([0, *((cut + 1) * size).tolist()])]
        if len(found) == len(chunks):
            return parts
        some, rest = iter(parts), iter(self._plainly([c.decode() for c, j in zip(chunks, joins) if not j]))
        return [next(some if j else rest) for j in joins]

    def _learn_bytes(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """As ``_learn``, for a byte-level file."""
        known, before = self.known, self.before
        long, stems, tails = [], set(), []
        for c in chunks:
            if c in before:
                known[c] = before[c]
            elif len(c) > LONGEST_CHUNK:
                long.append(c)
            elif c[-1] in _ENDS_BYTES and (stem := c.rstrip(_ENDS_BYTES))[-1:].isalpha():
                end = c[len(stem):]
                tails.append((c, stem, end))
                for part in (stem, end):
                    if part not in known:
                        stems.add(part)
            else:
                stems.add(c)
        if stems:
            new = list(stems)
            known.update(zip(new, self._together(new)))
        for c, stem, end in tails:
            known[c] = known[stem] + known[end]
        return dict(zip(long, self._together(long))) if long else {}

    def _encode_bytes(self, texts: list[str]) -> list[bytes]:
        """``encode`` for a byte-level file: Arrow tells the different chunks of
        all texts, and puts their ids in the chunks' places."""
        column = pa.array(texts, pa.large_string())
        odd = np.asarray(pc.or_(pc.match_substring(column, "<|"), pc.match_substring_regex(column, _OTHER_SPACE)), bool)
        data, off = text_bytes(column.filter(pa.array(~odd)) if odd.any() else column)
        starts = _chunk_starts(data, off)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]).dictionary_encode()
        different = _cut(chunks.dictionary, range(len(chunks.dictionary) + 1))
        got = list(map(self.known.get, different))
        gaps = [k for k, ids in enumerate(got) if ids is None]
        if gaps:
            long = self._learn_bytes([different[k] for k in gaps])
            for k in gaps:
                c = different[k]
                got[k] = long[c] if c in long else self.known[c]
        ids = pa.array(got, pa.large_binary()).take(chunks.indices)
        plain = _cut(ids, np.searchsorted(starts, off))
        if not odd.any():
            return plain
        plain, whole = iter(plain), iter(self._plainly([t for t, o in zip(texts, odd) if o]))
        return [next(whole if o else plain) for o in odd]

    def _learn(self, chunks: set[bytes]) -> dict[bytes, bytes]:
        """Remembers the ids of ``chunks`` (None where the text must be encoded
        whole) and returns those of chunks too long to be remembered."""
        known, before = self.known, self.before
        long, stems, tails = {}, {}, []
        for c in [c for c in chunks if c not in known]:  # ``- known.keys()`` walks through all that is known
            if c in before:
                known[c] = before[c]
                continue
            text = c.decode()
            if "<|" in text or (text[-1].isspace() and not _PLAIN_SPACE.issuperset(text)):
                known[c] = None
            elif len(text) > LONGEST_CHUNK:
                long[c] = text
            elif (stem := text.rstrip(_ENDS)) != text and stem and stem[-1] < "\u0130" and stem[-1].isalpha():
                cut = len(c) - len(text) + len(stem)  # the ends are ASCII: as many bytes as characters
                tails.append((c, c[:cut], c[cut:]))
                for part, said in ((c[:cut], stem), (c[cut:], text[len(stem):])):
                    if part not in known:
                        stems[part] = said
            else:
                stems[c] = text
        if stems:
            known.update(zip(stems, self._plainly(list(stems.values()))))
        for c, stem, end in tails:
            known[c] = known[stem] + known[end]
        return dict(zip(long, self._plainly(list(long.values())))) if long else long

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: none) as little-endian bytes."""
        texts = [t or "" for t in texts]
        if self.kind == "whole":
            return self._plainly(texts)
        collects = gc.isenabled()
        gc.disable()  # millions of strings and no cycles
        try:
            if len(self.known) > self.remembered:
                self.before, self.known = self.known, {}
            if self.kind == "byte":
                return self._encode_bytes(texts)
            known = self.known
            parts = [_lower_words(t) for t in texts]
            got = [list(map(known.get, chunks)) for chunks in parts]
            gaps = [[k for k, ids in enumerate(g) if ids is None] for g in got]
            long = self._learn({chunks[k] for chunks, gap in zip(parts, gaps) for k in gap})
            out = []
            for text, chunks, g, gap in zip(texts, parts, got, gaps):
                for k in gap:
                    c = chunks[k]
                    g[k] = long[c] if c in long else known[c]
                out.append(self._plainly([text])[0] if gap and None in g else b"".join(g))
        finally:
            if collects:
                gc.enable()
        return out


def _chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where a chunk of a byte-level file starts in the bytes of texts one after
    another: with a text, with a run of white space, with its last character if
    a word follows, and with a word unless a space or line feed stays with it."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    space = _IS_SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = first[:-1].copy()
    start[1:] |= space[1:] & ~space[:-1]
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:-1]
    start[1:] |= ~space[1:] & space[:-1] & ~_JOINS[data[:-1]]
    return np.flatnonzero(start)


def _cut(column: pa.LargeBinaryArray, at) -> list[bytes]:
    """The bytes of a fresh column from each of the values ``at`` to the next."""
    _, where, data = column.buffers()
    if not len(column):
        return [b""] * (len(at) - 1)
    ends = np.frombuffer(where, np.int64, len(column) + 1)[np.asarray(at)].tolist()
    raw = data.to_pybytes() if data is not None else b""
    return [raw[a:b] for a, b in pairwise(ends)]


def _lower_words(text: str) -> list[bytes]:
    """Words cut at ASCII white space; the word-end file lower-cases anyway."""
    return text.encode().lower().split()


def encoder(file, special_as_text: bool = False, remembered: int | None = None) -> Encoder:
    """The worker's encoder of a shipped file, loaded once per process."""
    start_task("encode")
    cache = process_cache()
    blob, kind = file.value
    key = ("encoder", zlib.crc32(blob), len(blob), special_as_text, remembered)
    if key not in cache:
        cache[key] = Encoder(blob, special_as_text, kind, remembered)
    return cache[key]


def some_rows(column, most: int = 1 << 20, rows: int = 256):
    """(first row, texts) of an Arrow column in turn, about ``most`` characters
    and at most ``rows`` rows at a time: what is made of a text takes tens of
    times its size, and the rest of the column stays in Arrow."""
    for at in range(0, len(column), rows):
        texts = column.slice(at, rows).to_pylist()
        for lo, hi in some_texts(texts, most):
            yield at + lo, texts[lo:hi]


def some_texts(texts: list[str | None], most: int = 4 << 20):
    """Index ranges of about ``most`` characters, to bound what is in memory."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
