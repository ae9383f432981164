"""Hierarchical packing of token sequences into windows of several lengths.

Every document is routed to the shortest tier that takes it whole; one longer
than the longest tier gives full windows and a rest that is routed. Each tier is
packed from the longest documents down. What a window has left is filled with
the longest documents of shorter tiers that fit, and the last gap with a piece
cut from the document that needs the least cutting, so a window has no padding
and at most one cut. What is left at a task's end goes into windows of falling
powers of two: no sequence is padded.

Windows of one tier are dealt to step groups of equal token counts, from the
costliest attention (sum of squared piece lengths) down and back, so the steps
of a group of workers cost about the same.

A task packs the documents it reads, in pools of a bounded number of tokens.
Nothing is shuffled, a lost task is computed again from its split, and no
document's or source's share of the rows makes a task larger than its split.

A null text is empty; an empty text is the end token alone. Null ids and repeated
rows are packed like others. No rows, no sequences.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultloom.llm.common import batch, kept, pieces, sliced, small_batches, texts_as_bytes

TIERS = (4096, 2048, 1024, 512, 256)
#: Tokens of a step group, tokens of a pool, words and stems of words remembered with their ids.
STEP_TOKENS, POOL_TOKENS, WORDS, STEMS = 65_536, 2_000_000, 150_000, 50_000
#: Bytes of texts whose words are parted at once.
PARTED = 1 << 18

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " `offset` long, tier int, step_group long"
)
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()),
    ("step_group", pa.int64()),
])


class WordIds(dict):
    """Ids of white-space separated words, four little-endian bytes each.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its words in order. It also parts letters from ASCII punctuation
    behind them and ignores ASCII case, so a text's words are mostly known when
    they come apart (see ``apart``), and a word with its punctuation is mostly a
    stem that is known. The memory is bounded: a full table becomes the old one,
    from which words are taken over when they come again.
    """

    letters = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer, self.old, self.stems, self.old_stems = Tokenizer.from_file(path), {}, {}, {}
        self.model, self.spelt = self.tokenizer.model, spelling(self.tokenizer)

    def __missing__(self, word: bytes) -> bytes:
        value = self.old.get(word) or self._new(word)
        if len(self) >= WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value

    def _new(self, word: bytes) -> bytes:
        if b"<|" in word:  # special tokens are read as such
            return self._encode(word)
        stem = word.rstrip(MARKS)
        tail = word[len(stem) :]
        if not tail or b"'" in tail or not stem[-1:].isalpha():
            return self._encode(word)
        if stem.isascii():
            stem = stem.lower()
        return self._stem(stem) + self._stem(tail)

    def _stem(self, stem: bytes) -> bytes:
        value = self.stems.get(stem)
        if value is None:
            value = self.old_stems.get(stem) or self._encode(stem)
            if len(self.stems) >= STEMS:
                self.old_stems, self.stems = self.stems, {}
            self.stems[stem] = value
        return value

    def _encode(self, word: bytes) -> bytes:
        low = word.lower().decode()  # of bytes, only ASCII letters change
        if self.spelt and self.letters(low):
            # What comes before the model does nothing to such a word but this, so the model is asked at once.
            found = self.model.tokenize(low if low.isascii() else low.lower().translate(self.spelt))
            return b"".join([t.id.to_bytes(4, "little") for t in found])
        ids = self.tokenizer.encode(word.decode(), add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)


def spelling(tokenizer) -> dict[int, str] | None:
    """How the model spells the lower-case letters of Latin-1.

    None if the model is not given words of Latin-1 letters whole and in lower case.
    """
    found = {}
    for letter in map(chr, (*range(97, 123), *range(0xDF, 0xF7), *range(0xF8, 0x100))):
        word = "a" + letter + "a"
        steps = tokenizer.normalizer, tokenizer.pre_tokenizer
        made = steps[0].normalize_str(word) if steps[0] else word
        parts = [p for p, _ in steps[1].pre_tokenize_str(made)] if steps[1] else []
        if 0xE0 <= ord(letter) <= 0xFE and (not steps[0] or steps[0].normalize_str(f"a{letter.upper()}a") != word):
            return None
        if made != word or len(parts) != 1 or parts[0][0] != "a" or parts[0][-1] != "a":
            return None
        found[ord(letter)] = parts[0][1:-1]
    # ASCII letters are not translated.
    return found if all(found[c] == chr(c) for c in range(97, 123)) else None


#: ASCII punctuation.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: Bits of a byte: ASCII letter or digit; punctuation; the same without the apostrophe, which may begin a
#: token of letters; behind a byte of the next kind the end of a letter; first byte of letters, but for the
#: two that the bit before leaves out. 0xC4 is not among them, as U+0130 in lower case ends in a mark.
_ALNUM, _MARK, _OPEN, _SECOND, _FIRST = 1, 2, 4, 8, 16
_KINDS = bytes(
    _ALNUM * (c < 128 and chr(c).isalnum())
    | (_MARK | _OPEN * (c != 39)) * (c in MARKS)
    | _SECOND * (0x80 <= c < 0xC0 and c not in (0x97, 0xB7))
    | _FIRST * (c in (0xC3, 0xC5, 0xC6, 0xC7, 0xC8, 0xC9, 0xD0, 0xD1))
    for c in range(256)
)


def apart(text: bytes) -> bytes:
    """A space where the tokenizer parts words whatever comes before or after; no special tokens are in the text.

    That is before ASCII punctuation behind a letter or digit, and behind punctuation
    other than the apostrophe before an ASCII letter or digit. ASCII case goes, unless
    there are combining marks, as a few compose with small letters only.
    """
    if b"\xcc" not in text and b"\xcd" not in text:  # the first bytes of all marks that compose with ASCII
        text = text.lower()
    kinds = np.frombuffer(text.translate(_KINDS), np.uint8)
    ends = kinds & _ALNUM
    ends[1:] |= (kinds[1:] // _SECOND) & (kinds[:-1] // _FIRST)
    cut = (ends[:-1] & (kinds[1:] // _MARK)) | (kinds[1:] & (kinds[:-1] // _OPEN) & _ALNUM)
    return np.insert(np.frombuffer(text, np.uint8), np.flatnonzero(cut) + 1, 32).tobytes()


def all_words(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Each text's words for ``WordIds``."""
    for a, b in pieces(texts, PARTED):
        # No text in UTF-8 has the byte 0xFF.
        plain = apart(b"\xff".join([b"" if b"<|" in t else t for t in texts[a:b]])).split(b"\xff")
        for text, spaced in zip(texts[a:b], plain, strict=True):
            yield (text if b"<|" in text else spaced).split()


def word_ids(path: str) -> WordIds:
    return kept(("packing", path), lambda: WordIds(path))


class Pool:
    """Pieces waiting to be packed, ordered by length: (length, key), the key leads to the piece."""

    def __init__(self):
        self.order: list[tuple[int, int]] = []
        self.pieces: dict[int, tuple] = {}
        self.tokens = self.next_key = 0

    def add(self, piece: tuple) -> None:
        """A piece is (doc_id, doc_tokens, start, ids)."""
        n = len(piece[3]) // 4
        if n:
            self.pieces[self.next_key] = piece
            insort(self.order, (n, self.next_key))
            self.tokens += n
            self.next_key += 1

    def _pop(self, at: int) -> tuple:
        n, key = self.order.pop(at)
        self.tokens -= n
        return self.pieces.pop(key)

    def longest_up_to(self, n: int) -> tuple | None:
        at = bisect_right(self.order, (n, 1 << 60))
        return self._pop(at - 1) if at else None

    def cut(self, n: int) -> tuple:
        """``n`` tokens from the shortest piece that has more; its rest stays."""
        at = bisect_right(self.order, (n, 1 << 60))
        doc, total, start, ids = self._pop(at)
        self.add((doc, total, start + n, ids[4 * n :]))
        return doc, total, start, ids[: 4 * n]

    def window(self, size: int) -> list[tuple]:
        """Exactly ``size`` tokens: whole pieces, the longest first, then one cut."""
        found = []
        while size:
            piece = self.longest_up_to(size) or self.cut(size)
            found.append(piece)
            size -= len(piece[3]) // 4
        return found


class Packer:
    """Windows from a task's pieces and rows from its windows."""

    def __init__(self, task: int, tiers: tuple[int, ...], step_tokens: int):
        self.tiers, self.step_tokens, self.pool = tiers, step_tokens, Pool()
        self.base, self.sequences, self.groups = task << 36, 0, 0
        self.made: dict[int, list] = defaultdict(list)
        self.rows: dict[str, list] = {f.name: [] for f in _ARROW}

    def add(self, doc_id, ids: bytes) -> None:
        top, total = self.tiers[0], len(ids) // 4
        whole = total // top * top
        for start in range(0, whole, top):
            self._finish(top, [(doc_id, total, start, ids[4 * start : 4 * (start + top)])])
        self.pool.add((doc_id, total, whole, ids[4 * whole :]))

    def _finish(self, tier: int, window: list[tuple]) -> None:
        """Keeps of a window what its rows need: the ids go."""
        pieces = [(d, s, len(i) // 4, zlib.crc32(i), t) for d, t, s, i in window]
        self.made[tier].append((sum(p[2] ** 2 for p in pieces), pieces))

    def pack(self) -> None:
        """Windows from the longest tier down, as long as the pool has tokens to fill one.

        What is left, less than the shortest tier, waits for the next pool.
        """
        pool = self.pool
        for tier, shorter in zip(self.tiers, (*self.tiers[1:], 0), strict=True):
            while pool.order and pool.order[-1][0] > shorter and pool.tokens >= tier:
                self._finish(tier, pool.window(tier))
        self._deal(whole=True)

    def end(self) -> None:
        self.pack()
        size = self.tiers[-1]
        while size:
            while self.pool.tokens >= size:
                self._finish(size, self.pool.window(size))
            size //= 2
        self._deal(whole=False)

    def _deal(self, whole: bool) -> None:
        """Windows of a tier to step groups, there and back by falling cost."""
        for tier, windows in self.made.items():
            each = max(1, self.step_tokens // tier)
            n = len(windows) // each if whole else -(-len(windows) // each)
            windows.sort(key=lambda w: -w[0])
            for k in range(min(n * each, len(windows))):
                lap, at = divmod(k, n)
                self._write(tier, windows[k][1], self.groups + (at if lap % 2 == 0 else n - 1 - at))
            self.groups += n
            del windows[: n * each]

    def _write(self, tier: int, pieces: list[tuple], group: int) -> None:
        offset, rows = 0, self.rows
        for doc_id, start, length, crc, total in pieces:
            values = (doc_id, start, length, crc, total, self.base + self.sequences, offset, tier, self.base + group)
            for name, value in zip(rows, values, strict=True):
                rows[name].append(value)
            offset += length
        self.sequences += 1

    def take(self) -> pa.RecordBatch:
        out = batch(_ARROW, self.rows)
        for column in self.rows.values():
            column.clear()
        return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    pool_tokens: int = POOL_TOKENS,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each piece. ``tokenizer`` is a path that every executor has; tiers are powers of two, falling."""
    if any(t & (t - 1) for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers are different powers of two, the longest first")
    small_batches(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids, packer = word_ids(tokenizer), Packer(TaskContext.get().partitionId(), tiers, step_tokens)
        for b in sliced(batches):
            found = all_words(texts_as_bytes(b.column(1)))
            for doc_id, words in zip(b.column(0).to_pylist(), found, strict=True):
                packer.add(doc_id, b"".join(map(ids.__getitem__, words)) + end)
                if packer.pool.tokens >= pool_tokens:
                    packer.pack()
                    yield packer.take()
        packer.end()
        yield packer.take()

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SCHEMA)
