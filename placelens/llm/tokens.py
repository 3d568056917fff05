"""Token ids of whole texts with public byte-level tokenizers.

A tokenizer file whose merges are numbered in the order of their ids is one and the same thing as a table of ranks, which
the rank encoder (`tiktoken`) reads about four times as fast as the file's own library. Whether a file is of that kind is checked when it is
loaded; other files are left to their own library, word by word where words can't influence each other.
"""

import json
import os

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer



def byte_characters() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary, the other way round.

    Printable Latin-1 characters stand for themselves, the other bytes in order for the characters from U+0100 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(0x100 + n): byte for n, byte in enumerate(others)}


def byte_level(file: str) -> dict[int, bytes] | None:
    """The bytes of every id of a byte-level file whose ids are ranks; None for any other file. Special ids are left out."""
    with open(file, encoding="utf-8") as lines:
        data = json.load(lines)
    model, before = data["model"], data["pre_tokenizer"] or {}
    plain = (before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) == ("ByteLevel", True, False)
    if not plain or data["normalizer"] or model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return None
    pairs = (merge.split(" ") if isinstance(merge, str) else merge for merge in model["merges"])
    made = [model["vocab"][a + b] for a, b in pairs]
    single = byte_characters()
    if made != sorted(set(made)) or len(made) + 256 != len(model["vocab"]) or min(made) < 256:
        return None
    return {number: bytes(single[c] for c in entry) for entry, number in model["vocab"].items()}


class Encoder:
    """Ids of texts as little-endian unsigned 16-bit bytes; the vocabulary must have at most 65,536 entries.

    The ids are those of `tokenizers` with `add_special_tokens=False`: the string of a special token in a text is that token.
    `plain` makes such strings ordinary text.
    """

    def __init__(self, file: str, plain: bool = False):
        self.plain = plain
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = plain
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("ids must fit 16 bits")
        special = {t.content: number for number, t in self.tokenizer.get_added_tokens_decoder().items()}
        table = byte_level(file)
        self.ranks = table and tiktoken.Encoding(
            os.path.basename(file), pat_str=public_tokenizers.PATTERN, mergeable_ranks={b: n for n, b in table.items()}, special_tokens=special
        )
        self.allowed = set() if plain else set(special)

    def ids(self, text: str) -> np.ndarray:
        if self.ranks:
            return self.ranks.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=())
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def encode(self, text: str) -> bytes:
        return self.ids(text).astype("<u2").tobytes()


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(file: str, plain: bool = False) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if (file, plain) not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        _encoders[file, plain] = Encoder(file, plain)
    return _encoders[file, plain]
