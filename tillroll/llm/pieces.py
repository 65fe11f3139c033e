"""Exact token ids of whole texts, each distinct word piece encoded once.

A text is cut before every U+0020 whose next character is certainly not white
space. No token of the two public pre-tokenizers spans such a cut: in the
byte-level one a space can only lead a match, a run of white space yields its
last space to the following word, and nothing looks behind; the word one drops
white space, and neither its normaliser (NFC, white-space runs, lower case per
character) nor an added token without spaces reaches across a space. So the ids
of a text are the ids of its pieces in order.

The distinct pieces of a slice are encoded in one call, joined by a separator
that becomes a token of its own. Pieces of plain Latin text go through
tiktoken's merge loop over the same vocabulary (the tokenizers library spends
about 20 microseconds on a rare word, that loop 3); all others go through the
tokenizers library itself. ``tests/llm`` holds both against the library on
whole texts, odd white space and random Unicode.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

JOINED = 512  # pieces that the tokenizers library gets in one call

# Bytes that may follow a space at a cut: printable ASCII, and lead bytes of
# which no character is white space or a format character near it.
_AFTER = np.zeros(256, bool)
_AFTER[0x21:0x7F] = True
_AFTER[0xC3:0xE1] = True
_AFTER[0xE4:0xEF] = True
_AFTER[0xF0:0xF5] = True

# Bytes of plain text: tab, line feed, printable ASCII and U+00C0 to U+02FF,
# on which all Unicode versions and normal forms agree.
_PLAIN = np.zeros(256, bool)
_PLAIN[[0x09, 0x0A]] = True
_PLAIN[0x20:0x7F] = True
_PLAIN[0x80:0xC0] = True
_PLAIN[0xC3:0xCC] = True

# For the word pattern: letters (1), digits (2), others (3), white space (0).
_WORD_SORT = np.full(256, 3, np.uint8)
_WORD_SORT[[0x09, 0x0A, 0x20]] = 0
_WORD_SORT[0x30:0x3A] = 2
_WORD_SORT[0x41:0x5B] = _WORD_SORT[0x61:0x7B] = 1
_WORD_SORT[0x80:] = 1

# The two pre-tokenizer patterns.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def cuts(data: np.ndarray) -> np.ndarray:
    """Byte positions of the spaces at which UTF-8 text may be cut."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    return np.flatnonzero((data[:-1] == 0x20) & _AFTER[data[1:]]).astype(np.int64)


def tokenizer_path(name: str) -> str:
    """A path as given, else the place of a public tokenizer of that name."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load(name: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def kind_of(spec: dict) -> str:
    """``byte`` or ``word`` where the cuts are proven, else ``other``."""
    if any(a["lstrip"] or a["rstrip"] or " " in a["content"] for a in spec["added_tokens"]):
        return "other"
    if spec["model"]["type"] != "BPE" or spec["model"].get("dropout") or spec["model"].get("ignore_merges"):
        return "other"
    pre, norm = spec["pre_tokenizer"] or {}, spec["normalizer"]
    if pre.get("type") == "ByteLevel" and norm is None and pre["use_regex"] and not pre["add_prefix_space"]:
        return "byte"
    steps = pre.get("pretokenizers", [])
    if (
        len(steps) == 2 and steps[0]["type"] == "Split" and steps[0]["pattern"].get("Regex") == WORD
        and steps[0]["invert"] and steps[0]["behavior"] == "Removed" and steps[1]["type"] == "ByteLevel"
        and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"] and norm is not None
        and [x["type"] for x in norm.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        and spec["model"]["end_of_word_suffix"] == "</w>"
    ):
        return "word"
    return "other"


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable
    bytes as themselves, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class PlainBytes:
    """tiktoken over the vocabulary of a byte-level tokenizer; special strings
    of the pieces are excluded by the caller."""

    def __init__(self, spec: dict):
        import tiktoken

        letters = byte_letters()
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.joint, self.sep_id = next(iter(added.items()))
        self.core = tiktoken.Encoding(
            "plain", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=added)._core_bpe

    def __call__(self, joined: str) -> np.ndarray:
        return np.frombuffer(self.core.encode_to_tiktoken_buffer(joined, {self.joint}), np.uint32)


class PlainWords:
    """The same for a vocabulary with word ends: a word end is the byte 0,
    which plain text lacks."""

    joint = " \x01 "

    def __init__(self, spec: dict):
        import tiktoken

        letters = byte_letters()
        added = {a["content"] for a in spec["added_tokens"]}
        ranks: dict[bytes, int] = {}
        for t, i in spec["model"]["vocab"].items():
            if t not in added:
                end = t.endswith("</w>") and len(t) > 4
                ranks[bytes(letters[c] for c in (t[:-4] if end else t)) + b"\0" * end] = i
        self.sep_id = ranks[b"\x01\0"]
        self.core = tiktoken.Encoding(
            "plain", pat_str=r"[^\x00\s]+\x00", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def __call__(self, joined: str) -> np.ndarray:
        """A word is a run of letters, a digit, or a run of other characters
        (no apostrophes here, so no contractions)."""
        data = np.frombuffer(joined.lower().encode(), np.uint8)
        sort = _WORD_SORT[data]
        ends = np.append((sort[:-1] != sort[1:]) | (sort[:-1] == 2), True) & (sort > 0)
        marked = np.zeros(len(data) + int(ends.sum()), np.uint8)
        marked[np.arange(len(data)) + np.cumsum(ends) - ends] = data
        text = marked.tobytes().decode()
        return np.frombuffer(self.core.encode_to_tiktoken_buffer(text, set()), np.uint32)


class PieceEncoder:
    def __init__(self, name: str):
        self.tok = load(name)
        spec = json.loads(self.tok.to_str())
        self.kind = kind_of(spec)
        self.plain = {"byte": PlainBytes, "word": PlainWords}[self.kind](spec) if self.kind != "other" else None
        special = [a for a in spec["added_tokens"] if a["special"] and not a["normalized"]]
        self.sep, self.sep_id = (special[-1]["content"], special[-1]["id"]) if special else (None, None)

    def _library(self, pieces: list[str]) -> list[np.ndarray]:
        """Ids of each piece by the library. An added token between pieces is
        split off before anything else; that makes one call of many."""
        out: list[np.ndarray] = []
        for at in range(0, len(pieces), JOINED):
            some = pieces[at: at + JOINED]
            if self.sep is not None and len(some) > 1 and not any("<|" in p or "|>" in p for p in some):
                ids = np.array(self.tok.encode(self.sep.join(some), add_special_tokens=False).ids, np.uint32)
                ends = np.flatnonzero(ids == self.sep_id)
                if len(ends) == len(some) - 1:
                    starts = [0, *(ends + 1)]
                    out += [ids[a:b] for a, b in zip(starts, [*ends, len(ids)])]
                    continue
            out += [np.array(self.tok.encode(p, add_special_tokens=False).ids, np.uint32) for p in some]
        return out

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per distinct piece the length and start of its ids, and the ids."""
        from tillroll.llm.common import text_buffers

        offsets, data = text_buffers(pieces)
        odd = ~_PLAIN[data]
        odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        odd[:-1] |= (data[:-1] == 0x7C) & (data[1:] == 0x3E)
        if self.kind == "word":  # contractions, two signs among the letters, one letter whose lower case is two
            odd |= (data == 0x27) | (data == 0xCB)
            odd[:-1] |= (data[:-1] == 0xC3) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
            odd[:-1] |= (data[:-1] == 0xC4) & (data[1:] == 0xB0)
        count = np.concatenate([[0], np.cumsum(odd)])
        plain = count[offsets[1:]] == count[offsets[:-1]]
        if self.plain is None:
            plain[:] = False
        lens, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        parts: list[np.ndarray] = []
        used = 0
        which = np.flatnonzero(plain)
        if len(which):
            some = pieces.take(pa.array(which))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), self.plain.joint)
            ids = self.plain(joined[0].as_py())
            ends = np.append(np.flatnonzero(ids == self.plain.sep_id), len(ids))
            assert len(ends) == len(which), "a separator was lost"
            starts[which] = np.concatenate([[0], ends[:-1] + 1])
            lens[which] = ends - starts[which]
            parts.append(ids)
            used = len(ids)
        which = np.flatnonzero(~plain)
        if len(which):
            own = self._library(pieces.take(pa.array(which)).to_pylist())
            lens[which] = [len(x) for x in own]
            starts[which] = used + np.cumsum(lens[which]) - lens[which]
            parts += own
        return lens, starts, np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Index of each piece's distinct form; per text the index of its
        first piece; the distinct pieces."""
        from tillroll.llm.common import text_buffers

        offsets, data = text_buffers(texts)
        at = offsets[:-1]
        if self.kind != "other":
            at = np.concatenate([at, cuts(data)])
            at.sort(kind="stable")
        at = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
        at = at[at < offsets[-1]]
        first = np.searchsorted(at, offsets)
        bounds = np.append(at, offsets[-1]).astype(np.int32)
        array = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
        coded = array.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False), first, coded.dictionary

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text (no nulls)."""
        which, first, distinct = self._pieces(texts)
        lens = self._distinct(distinct)[0]
        total = np.concatenate([[0], np.cumsum(lens[which])])
        return total[first[1:]] - total[first[:-1]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (n + 1) and the ids of all texts one after another."""
        which, first, distinct = self._pieces(texts)
        lens, starts, flat = self._distinct(distinct)
        each = lens[which]
        total = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(starts[which] - total[:-1], each) + np.arange(total[-1])]
        return total[first], ids


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(name: str) -> PieceEncoder:
    """One encoder per worker process and tokenizer."""
    if name not in _ENCODERS:
        _ENCODERS[name] = PieceEncoder(name)
    return _ENCODERS[name]
