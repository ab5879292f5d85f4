"""Tokenizers of public vocabularies, applied to whole texts.

A tokenizer splits a text before it merges, and no split part holds a space between two
other characters, nor a letter next to a sign other than an apostrophe. So a text is cut
where a space or line end follows another character and, in plain Latin text without
apostrophes, where letters and digits meet signs; distinct pieces are encoded once per
task and their ids are joined: the same ids as of the whole text. Texts with any other
white space are encoded whole, as are texts that hold the string of a special token: the
tokenizer finds those before anything else. ``tests/llm`` compares both on random texts.

A vocabulary file is read once, where the job is planned, and sent to the tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa

from .common import kept

_PIECE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_FINE = re.compile(r"[ \n]*(?:[A-Za-z0-9À-ÖØ-öø-ÿ]+|[^ \nA-Za-z0-9À-ÖØ-öø-ÿ]+)|[ \n]+")
#: The same without the space before a piece, for tokenizers that drop it.
_BARE = re.compile(r"[A-Za-z0-9À-ÖØ-öø-ÿ]+|[^ \nA-Za-z0-9À-ÖØ-öø-ÿ]+")
_CAPITALS = [chr(c) for c in [*range(65, 91), *range(0xC0, 0xDF)] if c != 0xD7]
#: What keeps a text from the fine cut: apostrophes, and characters that are neither ASCII nor letters of Latin-1.
_NOT_PLAIN = re.compile(r"[^\x20-\x26\x28-\x7e\nÀ-ÖØ-öø-ÿ]")
#: White space by any definition besides space and line end, and combining marks that a normaliser may move.
_OTHER = re.compile(r"[^\S \n]|[\x1c-\x1f\x85᠎​⁠﻿]")
#: Pieces whose ids a worker process keeps from task to task (about 200 bytes each); later ones are encoded again.
CACHE = 800_000


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary file's content. ``plain`` takes the strings of special tokens in a text as ordinary text."""

    content: str
    plain: bool = False

    @classmethod
    def load(cls, path: str, plain: bool = False) -> Vocabulary:
        return cls(Path(path).read_text(encoding="utf-8"), plain)

    def tokenizer(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        found = Tokenizer.from_str(self.content)
        found.encode_special_tokens = self.plain
        return found

    @property
    def width(self) -> int:
        """Bytes that hold any id."""
        return 2 if self.tokenizer().get_vocab_size() <= 1 << 16 else 4


class Encoder:
    """Encodes texts of a batch; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.kept: dict = kept(f"pieces of {zlib.crc32(vocabulary.content.encode())} {vocabulary.plain}")
        if None not in self.kept:  # once in a worker process, beside the pieces
            self.kept[None] = self._made(vocabulary)
        self.tokenizer, self.special, self.begins, self.folds, self.fine = self.kept[None]

    @staticmethod
    def _made(vocabulary: Vocabulary) -> tuple:
        """The tokenizer, its special tokens and how they begin, and what it does with capitals and spaces."""
        tokenizer = vocabulary.tokenizer()
        special = [] if vocabulary.plain else [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        found = re.compile("|".join(map(re.escape, special)), re.IGNORECASE) if special else None
        # how a special token may begin is looked for first, as that is far cheaper
        begins = sorted({re.match(r"[^\w\s]*", t)[0] for t in special})
        ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        # where capitals are as good as small letters, and spaces as none, more pieces are one
        folds = all(ids(f"x{c}y {c}") == ids(f"x{c.lower()}y {c.lower()}") for c in _CAPITALS)
        fine = _BARE if ids(" \n a\n b ") == ids("a") + ids("b") and not ids(" \n") else _FINE
        return tokenizer, found, begins, folds, fine

    def _encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 20_000):
            for found in self.tokenizer.encode_batch_fast(texts[at : at + 20_000], add_special_tokens=False):
                yield array("I", found.ids).tobytes()

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; of none for a null text."""
        known, whole, cut = self.kept, [], []
        for text in texts:
            if not text:
                cut.append(())
            elif self.special and any(b in text for b in self.begins) and self.special.search(text):
                cut.append(None)
                whole.append(text)
            elif not _NOT_PLAIN.search(text):
                cut.append(self.fine.findall(text.lower() if self.folds else text))
            elif _OTHER.search(text):
                cut.append(None)
                whole.append(text)
            else:
                cut.append(_PIECE.findall(text))
        distinct = set(chain.from_iterable(pieces for pieces in cut if pieces))
        new = list(distinct.difference(known))
        if new and len(known) + len(new) > CACHE:
            known = {p: known[p] for p in distinct if p in known}
        known.update(zip(new, self._encode(new)))
        long, get = self._encode(whole), known.__getitem__
        return [np.frombuffer(next(long) if pieces is None else b"".join(map(get, pieces)), np.uint32) for pieces in cut]


def encoded(batches: Iterator[pa.RecordBatch], column: int, vocabulary: Vocabulary, end: int, rows: int = 512) -> Iterator[tuple]:
    """(batch, ids of each row with the end id) for runs of rows."""
    encode = Encoder(vocabulary)
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            b = whole.slice(at, rows)
            yield b, [np.append(ids, np.uint32(end)) for ids in encode(b.column(column).to_pylist())]
