"""Public tokenizers inside Arrow functions: one loaded per worker, texts encoded whole and in order.

A byte-level BPE file of the ``tokenizers`` library gives the same ids in ``tiktoken``, which is about four
times faster, when its merges are in the order of their ids and nothing but byte-level splitting surrounds
them. ``encoder`` tests a file for this and otherwise takes the file's own library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

#: Where a text may be cut without any change of its ids: at a blank between two ASCII letters or digits.
SAFE = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")
LONG = 1 << 18


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[str, int]:
    """Byte-level files write each byte as one printable character: itself, or the next from U+0100."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _as_tiktoken(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and all(t["special"] and not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in spec["added_tokens"])
    )
    if not plain:
        return None
    alphabet = _byte_alphabet()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if [vocabulary.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
        return None
    ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[list[str]], list[np.ndarray]]:
    """A function from texts to their ids, as the file's library gives them without added tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [np.array(x, dtype=np.uint32) for x in pieces.encode(texts, num_threads=1)]
    if path.endswith(".json") and (fast := _as_tiktoken(path)):
        return lambda texts: [fast.encode_to_numpy(x, allowed_special="all", disallowed_special=()) for x in texts]
    if not path.endswith(".json"):
        raise ValueError(f"no library for {path}")
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return lambda texts: [np.array(x.ids, dtype=np.uint32) for x in own.encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=4)
def splits_at_blanks(path: str) -> bool:
    """Whether a file surely gives the same ids when a text is cut before a blank between two letters or digits.

    So do byte-level files that split texts by their own pattern, add no blank before a text, change no characters
    and have no added token with a blank in it. Texts of all other files are encoded whole.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space")
        and not any(" " in t["content"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    )


def cut_safely(text: str, size: int = LONG) -> list[str]:
    """Parts of about ``size`` characters whose ids joined are the ids of the text (see ``splits_at_blanks``)."""
    parts, start = [], 0
    while len(text) - start > size:
        at = SAFE.search(text, start + size)
        if at is None:
            break
        parts.append(text[start : at.start()])
        start = at.start()
    return [*parts, text[start:]]


def encode(texts: list[str | None], path: str) -> list[list[np.ndarray]]:
    """The ids of each text, as the parts of a long one (nulls count as empty)."""
    out = []
    for text in texts:
        text = text or ""
        out.append(encoder(path)(cut_safely(text) if len(text) > LONG and splits_at_blanks(path) else [text]))
    return out
