"""Whole-text encoding with a public tokenizer file, one chunk at a time.

A text is cut only where the tokenizer itself always cuts, so the ids of the
chunks put together are the ids of the text. Chunks recur, so their ids are
kept in a bounded table per Python worker, which its next tasks find again, and
only new chunks are encoded.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np

# The characters that count as white space in Unicode, which is
# what the tokenizers' patterns mean by \s.
WHITE = " \t\n\x0b\x0c\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
KEPT_WHITE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
PIECE = 1 << 20
LONGEST_KEPT = 48
PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"  # all \p{L}, composed, one pre-token when alone
KEPT_CHUNKS = 350_000


def chunk_rule(config: dict) -> str:
    """How texts may be cut for a tokenizers file: ``drop`` (white space
    separates and is dropped), ``lead`` (byte-level pattern: a run of white
    space never joins what stands before it) or ``whole`` (not at all)."""
    pre = config.get("pre_tokenizer") or {}
    norm = config.get("normalizer")
    if any(t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"]) for t in config["added_tokens"]):
        return "whole"
    if config["model"]["type"] != "BPE" or config["model"].get("dropout"):
        return "whole"
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "lead"
    parts = (norm or {}).get("normalizers", [])
    splits = pre.get("pretokenizers", [])
    if (
        [p["type"] for p in parts] == ["NFC", "Replace", "Lowercase"]
        and parts[1]["pattern"] == {"Regex": "\\s+"}
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and splits[0]["behavior"] == "Removed"
        and splits[0]["invert"]
        and not splits[1]["use_regex"]
        and not splits[1]["add_prefix_space"]
    ):
        return "drop"
    return "whole"


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut a very long text before runs of white space, about every ``size``
    characters, so the list of its chunks stays small."""
    start = 0
    edge = re.compile(f"[^{WHITE}](?=[{WHITE}])")
    while len(text) - start > size:
        m = edge.search(text, start + size)
        if not m:
            break
        yield text[start : m.end()]
        start = m.end()
    yield text[start:] if start else text


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies:
    itself where it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


_KEPT_ENCODERS: dict = {}


def shared_encoder(path: str, kind: str) -> ChunkEncoder:
    """The Python worker's encoder for a file: ``count`` or an id type such as
    ``<u2`` (values are the ids' bytes). Later tasks of the worker reuse it."""
    if (path, kind) not in _KEPT_ENCODERS:
        _KEPT_ENCODERS[path, kind] = ChunkEncoder(
            path, len if kind == "count" else lambda ids: np.array(ids, kind).tobytes()
        )
    return _KEPT_ENCODERS[path, kind]


class ChunkEncoder:
    """``values(text)`` gives values of a text's chunks in order; ``value`` makes
    one from a chunk's ids, and values add up (counts, lists, bytes). Two
    generations of at most ``kept`` chunks are held."""

    def __init__(self, path: str, value: Callable[[list[int]], object], kept: int = KEPT_CHUNKS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.rule = chunk_rule(config)
        self.special = [t["content"].lower() for t in config["added_tokens"]]
        self.tokenize = self.tokenizer.model.tokenize
        self.word = re.compile(f"[{LETTERS}]+" if self.rule == "drop" else f" ?[{LETTERS}]+")
        self.alphabet = byte_alphabet()
        self.value, self.kept = value, kept
        self.new: dict = {}
        self.old: dict = {}

    def chunks(self, text: str) -> list:
        if self.rule == "drop":
            data = text.encode()
            low = data.lower()  # A-Z only; the tokenizer lower-cases all the same
            if not any(t.encode() in low for t in self.special):
                data = low
            return data.split()  # ASCII white space only: a subset of what separates
        return KEPT_WHITE.findall(text)

    def encode(self, text: str):
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def values(self, text: str) -> list:
        if self.rule == "whole":
            return [self.encode(text)]
        out: list = []
        for piece in pieces(text):
            out += self._piece(self.chunks(piece))
        return out

    def _piece(self, chunks: list) -> list:
        out = list(map(self.new.get, chunks))
        if None not in out:
            return out
        out = [self._find(c) if v is None else v for c, v in zip(chunks, out)]
        if len(self.new) > self.kept:
            self.old, self.new = self.new, {}
        return out

    def _find(self, chunk):
        v = self.new.get(chunk)
        if v is None:
            v = self.old.get(chunk)
            if v is None:
                v = self._encode_chunk(chunk)
            if len(chunk) <= LONGEST_KEPT:
                self.new[chunk] = v
        return v

    def _encode_chunk(self, chunk):
        """A new chunk: punctuation after an ASCII letter always begins a token
        of its own; a lone word of plain letters goes to the model directly."""
        as_bytes = isinstance(chunk, bytes)
        core = chunk.rstrip(PUNCTUATION.encode() if as_bytes else PUNCTUATION)
        if len(core) < len(chunk) and core and core[-1:].isascii() and core[-1:].isalpha():
            text = chunk.decode() if as_bytes else chunk
            if not any(t in text.lower() for t in self.special):
                return self._find(core) + self._find(chunk[len(core) :])
        text = chunk.decode() if as_bytes else chunk
        if self.word.fullmatch(text) and (self.rule == "lead" or text.islower()):
            level = self.alphabet
            return self.value([t.id for t in self.tokenize("".join([level[b] for b in text.encode()]))])
        return self.encode(text)
