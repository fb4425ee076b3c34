"""Token ids of whole texts with a public byte-level vocabulary, for the packing operators.

A byte-level pattern never joins what stands before a space to what follows it, so a text is
cut there and each distinct piece is encoded once per worker; the ids of a text are gathered
from those of its pieces. Texts with other white space runs, or with a special token's string,
go to the library whole. Both ways give the ids the library gives for the whole text.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np

from corpusmill.functions.byte_symbols import SYMBOLS

SYMBOL_OF = dict(enumerate(SYMBOLS))
MEMO = 1_000_000

# A piece may end in some of these: they are a token run of their own after letters.
TAIL = ".,;:!?*%&$#|"

def vocabulary(path: str | None = None) -> str:
    """Text of the tokenizer file; by default the public 50k byte-level vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def _pieces(text: str) -> list[str] | None:
    """The first word and the pieces after it; None for a text with unusual white space."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[-1:] in " \n":
        return None
    own = text.replace("\n", " \n").split(" ")
    # Any other white space would make more words.
    return own if len(text.split()) == len(own) - (not own[0]) else None


class _Numbers(dict):
    """Pieces by number; a new piece gets the next one and waits to be encoded."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.waiting.append(piece)
        number = self[piece] = len(self)
        return number


class Encoder:
    """Encodes texts to ``uint32`` ids, without special tokens added; ``end_id`` may follow."""

    def __init__(self, path: str | None = None, end_id: int | None = 0):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_str(vocabulary(path))
        self.end = np.array([] if end_id is None else [end_id], np.uint32)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        # The parts of a piece can be told apart only where the file asks for nothing but bytes.
        self.plain = (
            isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and self.tokenizer.normalizer is None
        )
        self.model = self.tokenizer.model
        self.line_end = self._whole("\n")
        self._clear()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _clear(self) -> None:
        self.known = _Numbers()
        self.tails: dict[str, list[int]] = {"": []}
        self.flat, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.starts = self.sizes

    def _word(self, word: str) -> list[int]:
        """A word of letters, or a space and one: a single run, so the model alone has its ids."""
        if word.isascii():
            symbols = word.replace(" ", SYMBOL_OF[32])
        else:
            symbols = word.encode().decode("latin-1").translate(SYMBOL_OF)
        return [token.id for token in self.model.tokenize(symbols)]

    def _learn(self) -> None:
        """Encode the waiting pieces: a word after a space, or a line end and a line's first word."""
        pieces, self.known.waiting = self.known.waiting, []
        flat: list[int] = []
        sizes: list[int] = []
        words: dict[str, list[int]] = {}
        for piece in pieces:
            stem = piece.rstrip(TAIL)
            starts_line = stem[:1] == "\n"
            letters = stem[1:] if starts_line else stem
            if letters.isalpha():
                word = letters if starts_line else " " + letters
                ids = words.get(word)
                if ids is None:
                    ids = words[word] = self._word(word)
                if starts_line:
                    ids = self.line_end + ids
                if len(stem) < len(piece):
                    tail = piece[len(stem) :]
                    if tail not in self.tails:
                        self.tails[tail] = self._whole(tail)
                    ids = ids + self.tails[tail]
            else:
                ids = self._whole(piece if piece[:1] == "\n" else " " + piece)
            flat += ids
            sizes.append(len(ids))
        self.flat = np.append(self.flat, np.array(flat, np.uint32))
        self.sizes = np.append(self.sizes, np.array(sizes, np.int64))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        if len(self.known) > MEMO:
            self._clear()
        number = self.known.__getitem__
        cut: list[tuple[str, np.ndarray] | None] = []
        for text in texts:
            usual = self.plain and text and not (self.special and self.special.search(text))
            own = _pieces(text) if usual else None
            if own is None:
                cut.append(None)
                continue
            # A text that starts with a line end has an empty first piece.
            cut.append((own[0], np.fromiter(map(number, own[1:]), np.int64, len(own) - 1)))
        self._learn()
        out = []
        for text, own in zip(texts, cut):
            if own is None:
                ids = [np.array(self._whole(text), np.uint32)] if text else []
            else:
                first, place = own
                size = self.sizes[place]
                shift = self.starts[place] - (np.cumsum(size) - size)
                ids = [self.flat[np.repeat(shift, size) + np.arange(size.sum())]]
                if first.isalpha():
                    ids.insert(0, np.array(self._word(first), np.uint32))
                elif first:
                    ids.insert(0, np.array(self._whole(first), np.uint32))
            out.append(np.concatenate([*ids, self.end]))
        return out


def encoder(path: str | None = None, end_id: int | None = 0) -> Encoder:
    """One encoder per worker and vocabulary.

    It is kept on an imported module: this package's own code comes anew with each task.
    """
    import tokenizers

    made = vars(tokenizers).setdefault("_corpusmill_encoders", {})
    key = path, end_id
    if key not in made:
        made[key] = Encoder(path, end_id)
    return made[key]


def release_encoders() -> None:
    """Free the encoders of this worker; tasks of other operators need the memory.

    A worker outlives its task, and Spark has no call for the end of a stage.
    """
    import sys

    if library := sys.modules.get("tokenizers"):
        vars(library).pop("_corpusmill_encoders", None)
