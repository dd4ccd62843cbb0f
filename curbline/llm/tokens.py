"""Token ids of many texts through a public tokenizer, remembering the ids of frequent parts."""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np

from curbline.llm.common import held

#: Parts and ids kept by one Python worker before it drops the rarer ones (some 100 MB).
KEPT_PARTS = 300_000
KEPT_IDS = 3_000_000
#: Characters of Latin scripts whose normal and lower-case forms are plain, and common white space. Words with
#: any other are not parted here but go through the whole tokenizer.
ODD = re.compile(r"[^ \t\r\n!-~¡-¬®-įı-ſ]")
#: Fixed value: how the vocabulary ``word_bpe_49k.json`` parts a text in lower case, for those characters.
LETTER, NUMBER = "a-zªµºß-öø-ſ", "0-9²³¹¼-¾"
PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^\s{LETTER}{NUMBER}]+")
#: Stands before a whole word among the parts.
WHOLE = "\0"


def byte_characters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(byte) if byte in visible else chr(next(hidden)) for byte in range(256)]


class PartEncoder:
    """Encodes texts part by part, for the vocabulary ``word_bpe_49k.json`` and others of its kind.

    It drops white space and encodes each part of a text by itself, so that a text's ids are those of its
    parts one after the other. ``encode`` gives one array for several texts, and where each ends in it.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.bytes = byte_characters()
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.lengths = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def drop_rare(self) -> None:
        """Keep the more frequent parts, half of all that may be kept at most."""
        known, lengths, starts, uses, ids = self.place, self.lengths, self.starts, self.uses, self.ids
        self.clear()
        half = len(uses) // 2
        often = uses > max(1, int(np.partition(uses, half)[half]))
        often &= np.cumsum(np.where(often, lengths, 0)) <= KEPT_IDS // 2
        parts = [part for part, keep in zip(known, often.tolist(), strict=True) if keep]
        spans = zip(starts[often].tolist(), lengths[often].tolist(), strict=True)
        self.add(parts, [ids[start : start + length] for start, length in spans])

    def add(self, parts: list[str], found: list) -> None:
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.place.update(zip(parts, range(len(self.place), len(self.place) + len(parts)), strict=True))
        first = len(self.ids)
        self.starts = np.concatenate([self.starts, first + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(parts), np.int64)])
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        self.ids = np.concatenate([self.ids, flat])

    def part_ids(self, part: str) -> list[int]:
        if part.startswith(WHOLE):
            return self.tokenizer.encode(part.removeprefix(WHOLE), add_special_tokens=False).ids
        spelled = part if part.isascii() else "".join(map(self.bytes.__getitem__, part.encode()))
        return [token.id for token in self.model.tokenize(spelled)]

    def odd(self, text: str) -> bool:
        return bool(ODD.search(text)) or any(token in text for token in self.added)

    def parts_of(self, text: str) -> list[str]:
        if not self.odd(text):
            return PARTS.findall(text.lower())
        parts: list[str] = []
        for word in re.split("[ \n]+", text):
            parts += [WHOLE + word] if self.odd(word) else PARTS.findall(word.lower())
        return parts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.place) > KEPT_PARTS or len(self.ids) > KEPT_IDS:
            self.drop_rare()
        parts: list[str] = []
        ends = np.zeros(len(texts), np.int64)
        for row, text in enumerate(texts):
            parts += self.parts_of(text)
            ends[row] = len(parts)
        codes = np.fromiter(map(self.place.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            unknown = [parts[i] for i in missing.tolist()]
            new = list(dict.fromkeys(unknown))
            self.add(new, list(map(self.part_ids, new)))
            codes[missing] = np.fromiter(map(self.place.__getitem__, unknown), np.int64, len(unknown))
        self.uses += np.bincount(codes, minlength=len(self.uses))
        lengths = self.lengths[codes]
        after = np.cumsum(lengths)
        gather = np.arange(int(after[-1]) if len(after) else 0)
        gather += np.repeat(self.starts[codes] - (after - lengths), lengths)
        after = np.concatenate([[0], after])
        return self.ids[gather], after[ends]


def part_encoder(path: str) -> PartEncoder:
    """The encoder of this Python worker for a vocabulary file."""
    return held("tokens", path, lambda: PartEncoder(path))
