"""Exact word-by-word encoding with a tokenizers file whose tokens never span white space.

The library gives every id; what is kept between texts is only which ids a word got. A text's ids
are its words' ids in turn because the file's normalizer turns every white-space run into one
space and its pre-tokenizer never puts white space into a token. Files of another build are
encoded whole.
"""

from __future__ import annotations

import json
import os
import re

# Fixed values of the file's build that make splitting at white space exact.
NORMALIZER = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Words of these characters are normal forms already and lower-case letter by letter.
PLAIN = re.compile("[\x21-\x7e\xc0-\xff]+")
#: The split above for lower-cased words of PLAIN.
PLAIN_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


#: Bytes that a worker's caches of words and of their parts may take, and what an entry takes
#: beside its word and ids. Longer words are not kept.
ROOM, ENTRY, LONGEST = {"words": 96 << 20, "parts": 32 << 20}, 200, 64


class WordEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    The caches take at most `room` bytes and are emptied when full, so memory is bounded whatever
    the words are.
    """

    def __init__(self, path: str, room: dict[str, int] = ROOM):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.room = room
        with open(path, encoding="utf-8") as f:
            build = json.load(f)
        steps = (build.get("normalizer") or {}).get("normalizers", [])
        cuts = (build.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            [s["type"] for s in steps] == NORMALIZER
            and steps[1]["pattern"] == {"Regex": "\\s+"}
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": SPLIT}
            and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
            and not any(re.search(r"\s", t["content"]) for t in build.get("added_tokens", []))
        )
        self.added = [t["content"] for t in build.get("added_tokens", [])]
        self.letters = byte_letters()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.held = {"words": 0, "parts": 0}

    def keep(self, name: str, word: bytes | str, ids: bytes) -> None:
        if len(word) > LONGEST:
            return
        cache = getattr(self, name)
        self.held[name] += ENTRY + len(word) + len(ids)
        if self.held[name] > self.room[name]:
            cache.clear()
            self.held[name] = ENTRY + len(word) + len(ids)
        cache[word] = ids

    def whole(self, text: str) -> bytes:
        import numpy as np

        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part(self, part: str) -> bytes:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        got = b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(shown)])
        self.keep("parts", part, got)
        return got

    def word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "surrogatepass")
        if text.isalpha() and max(text) <= "\xff":
            low = text.lower()
            got = self.parts.get(low) or self.part(low)
        elif not PLAIN.fullmatch(text) or any(a in text for a in self.added):
            got = self.whole(text)
        else:
            got = b"".join([self.parts.get(p) or self.part(p) for p in PLAIN_SPLIT.findall(text.lower())])
        self.keep("words", word, got)
        return got

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self.whole(text)
        known, out = self.words, []
        for w in text.encode("utf-8", "surrogatepass").split():
            got = known.get(w)
            out.append(self.word(w) if got is None else got)
        return b"".join(out)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, kept over its tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
