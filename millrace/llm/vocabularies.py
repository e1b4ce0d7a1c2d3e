"""Tokenizer files as values for tasks: one version, one way to load, whatever the library.

Only the driver reads a file; its bytes (some MB at most, whatever the input) travel with the tasks.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

#: The mark that a piece vocabulary writes for a blank.
BLANK = "▁"
#: Characters that are given to a tokenizer at once where a text may be cut.
PART = 1 << 15


# Fixed value: the pattern by which byte-level vocabularies cut a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others in
    order from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """The file of a tokenizer: ``json`` for the tokenizers library, ``model`` for sentencepiece."""

    kind: str
    content: bytes

    @staticmethod
    def read(path: str) -> Vocabulary:
        kind = path.rsplit(".", 1)[-1]
        if kind not in ("json", "model"):
            raise ValueError(f"{path}: a .json or .model file is expected")
        with open(path, "rb") as file:
            return Vocabulary(kind, zlib.compress(file.read(), 9))

    @property
    def raw(self) -> bytes:
        return zlib.decompress(self.content)

    @property
    def version(self) -> str:
        """Digest of all that decides a text's tokens: the file, its kind and the library's version."""
        import sentencepiece
        import tokenizers

        library = (tokenizers if self.kind == "json" else sentencepiece).__version__
        return hashlib.sha256(f"{self.kind} {library} ".encode() + self.raw).hexdigest()


@lru_cache(maxsize=4)
def json_tokenizer(vocabulary: Vocabulary, plain: bool = False):
    """Without truncation and padding; ``plain`` takes the strings of special tokens as ordinary text."""
    import tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = tokenizers.Tokenizer.from_str(vocabulary.raw.decode())
    made.no_truncation()
    made.no_padding()
    made.encode_special_tokens = plain
    return made


@lru_cache(maxsize=4)
def ranked(vocabulary: Vocabulary):
    """The same vocabulary as ranks, which is encoded some times faster; None where it is not one.

    It is one if bytes and merges have their ids in order, every entry is a byte or one merge's result, and the text is cut
    by the byte-level pattern and nothing else is done to it.
    """
    import tiktoken

    made = json.loads(vocabulary.raw)
    model, cut = made["model"], made["pre_tokenizer"] or {}
    plain = made["normalizer"] is None and model["type"] == "BPE" and not any(
        model.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    )
    if not plain or cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space"):
        return None
    letters, entries = byte_alphabet(), model["vocab"]
    special = {token["content"] for token in made["added_tokens"]}
    ranks = {bytes(letters[c] for c in entry): i for entry, i in entries.items() if entry not in special and set(entry) <= letters.keys()}
    merged = [entries.get("".join(pair) if isinstance(pair, list) else pair.replace(" ", "")) for pair in model["merges"]]
    if None in merged or merged != list(range(256, 256 + len(merged))) or sorted(ranks.values()) != list(range(len(merged) + 256)):
        return None
    return tiktoken.Encoding(vocabulary.version, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})


def plain_ids(vocabulary: Vocabulary, texts: list[str]) -> list[list[int]]:
    """Ids of every text of a json vocabulary, special tokens' strings as ordinary text."""
    fast = ranked(vocabulary)
    if fast is not None:
        return fast.encode_ordinary_batch(texts, num_threads=1)
    return [found.ids for found in json_tokenizer(vocabulary, plain=True).encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def piece_model(vocabulary: Vocabulary):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=vocabulary.raw)


@lru_cache(maxsize=4)
def divisible(vocabulary: Vocabulary) -> bool:
    """Whether a piece model treats what stands before and behind a blank apart.

    It does if blanks are kept one by one, a blank is put before a text, and no piece has a blank behind another
    character: pieces arise by joining neighbours to pieces, so none ever spans such a place.
    """
    model = piece_model(vocabulary)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    spans = any(BLANK in name.lstrip(BLANK) for name in names)
    return not spans and model.normalize("x  y ") == f"{BLANK}x{BLANK}{BLANK}y{BLANK}"


def parts(text: str, step: int = PART) -> Iterator[str]:
    """``text`` cut before blanks that follow no other white space, at about every ``step`` characters. The first part
    begins as the text does, every other one with its blank; none is a blank alone, which a model would not see."""
    at = 0
    while at < len(text):
        stop = at + step
        while (stop := text.find(" ", stop)) >= 0 and (text[stop - 1].isspace() or text[stop - 1] == BLANK):
            stop += 1
        stop = len(text) if stop < 0 or stop == len(text) - 1 else stop
        yield text[at:stop]
        at = stop


def piece_ids(vocabulary: Vocabulary, texts: list[str]) -> list[list[int]]:
    """Ids of every text, as the library gives them for the whole text; long texts go to it in parts."""
    model = piece_model(vocabulary)
    if not divisible(vocabulary):
        return model.encode(texts, num_threads=1)
    cut = [list(parts(" " + text)) if text else [] for text in texts]
    found = iter(model.encode([part[1:] for some in cut for part in some], num_threads=1))
    return [[i for _ in some for i in next(found)] for some in cut]
