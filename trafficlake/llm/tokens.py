"""Token ids by a byte-level BPE, with a cache of word chunks."""

import json
import os
import re
import struct
from collections.abc import Iterator

import tiktoken
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"

# Fixed value: the pattern of words within which byte-level BPE of this kind merges.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The special string of the vocabulary, and white space other than space and line feed. A text with
#: one of these is encoded whole; any other splits at words exactly as the tokenizer itself would.
_SPECIAL = "<|endoftext|>"
_OTHER_SPACE = re.compile(f"[{''.join(chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) not in ' \n')}]")
#: Spaces and line feeds that meet; texts with these, or with one at an end, are split by pattern.
_MEETING = ("  ", "\n\n", " \n", "\n ")
_CHUNK = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]")

_CACHED = 150_000
_LONG = 64
_SLICE_CHARS = 1_000_000

_coders: dict[str, tuple] = {}


def vocabulary_path(name: str) -> str:
    """``name`` if it is a path, else the file of that name among the installed public vocabularies."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: printable ones as they are, the others
    from 256 on in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _by_ranks(path: str):
    """A coder of plain text from the same vocabulary, None unless its ids are in the order of its merges.

    Merging by the rank of the result is then what merging by the order of merges is, and several times as
    fast for short texts.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(model["vocab"].get("".join(pair)) != 256 + i for i, pair in enumerate(merges)):
        return None
    characters = _byte_characters()
    count = 256 + len(merges)
    ranks = {bytes(map(characters.__getitem__, token)): i for token, i in model["vocab"].items() if i < count}
    return tiktoken.Encoding("vocabulary", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})


def _coder(name: str) -> tuple:
    if name not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = vocabulary_path(name)
        _coders[name] = (Tokenizer.from_file(path), _by_ranks(path), [{}, {}])
    return _coders[name]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _whole(coder: Tokenizer, text: str) -> bytes:
    return _packed(coder.encode(text, add_special_tokens=False).ids)


def _chunks(text: str) -> list[str] | None:
    """Pieces of a text that are encoded one by one, as cache keys; None if it must be encoded whole.

    A key that starts with a line feed or a zero character stands for what follows the zero or for itself,
    any other for itself after a space.
    """
    if _SPECIAL in text or "\0" in text or _OTHER_SPACE.search(text):
        return None
    if text.strip(" \n") != text or any(x in text for x in _MEETING):
        return [c[1:] if c[0] == " " and c[1:2] not in ("", " ", "\n") else f"\0{c}" for c in _CHUNK.findall(text)]
    return f"\0{text}".replace("\n", " \n").split(" ") if text else []


def _spelled(key: str) -> str:
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else f" {key}"


def encode(texts: list[str | None], vocabulary: str = VOCABULARY) -> Iterator[bytes]:
    """For each text its ids as little-endian unsigned 32-bit numbers; none for null and empty texts.

    The vocabulary's word pattern never joins what a space or line feed separates, so the ids of a text are
    those of its chunks in a row. Chunks are encoded once and kept; when there are many, those not seen since
    the last time there were many go.
    """
    coder, ranked, generations = _coder(vocabulary)
    encoded = (lambda text: _packed(ranked.encode_ordinary(text))) if ranked else (lambda text: _whole(coder, text))
    at = 0
    while at < len(texts):
        chunks: list[list[str] | None] = []
        size = 0
        while at < len(texts) and size < _SLICE_CHARS:
            text = texts[at] or ""
            chunks.append(_chunks(text))
            size += len(text)
            at += 1
        if len(generations[0]) > _CACHED:
            generations[:] = [{}, generations[0]]
        cache, older = generations
        new = set().union(*filter(None, chunks)).difference(cache)
        seen = new.intersection(older)
        cache.update(zip(seen, map(older.__getitem__, seen)))
        new = list(new - seen)
        cache.update(zip(new, map(encoded, map(_spelled, new))))
        for i, keys in enumerate(chunks, at - len(chunks)):
            yield _whole(coder, texts[i]) if keys is None else b"".join(map(cache.__getitem__, keys))
        for key in new:
            if len(key) > _LONG:
                del cache[key]
