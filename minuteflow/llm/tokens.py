"""Token ids of many texts, with the ids of words already seen at hand.

Byte-level BPE splits a text before it merges, and never across the space before
a word, so the ids of a text are those of its pieces ``space + word`` one after
the other. Words come back again and again, and the ids of up to ``MOST`` of
them are kept per worker, until its task ends: workers live on beside later steps. Texts where the split could differ (a space within a
run of white space, control characters, special tokens) are encoded whole.

The vocabulary is read from a ``tokenizers`` file, and for single words from the
same vocabulary's rank file, which gives the same ids faster.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST = 200_000
AT_ONCE = 1_000
# A space inside a run of white space, white space beyond ASCII, control characters, special tokens.
_ODD = (
    r"[ \n\t\r\x0b\x0c] |[\x1c-\x1f]|<\|"
    r"|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_TAILS = ".,;:!?|#$%&*"


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class _Words(dict):
    """Word -> packed ids of a space and the word, filled as words come up."""

    def __init__(self, encode):
        self.encode, self.tails = encode, {}

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(_TAILS)
        if stem != word and stem.isalpha():
            # Letters and the marks after them are split before merging.
            tail = word[len(stem) :]
            if tail not in self.tails:
                self.tails[tail] = _packed(self.encode(tail))
            ids = self[stem] + self.tails[tail]
        else:
            ids = _packed(self.encode(" " + word))
        self[word] = ids
        return ids


class WordTokens:
    """Ids of texts as packed unsigned 32-bit numbers."""

    @classmethod
    def of(cls, path: str, ranks: str) -> WordTokens:
        """The encoder of this worker process, shared by its tasks.

        Functions travel to workers by value, so it hangs on an imported module.
        """
        import tokenizers

        made = tokenizers.__dict__.setdefault("_word_tokens", {})
        if (path, ranks) not in made:
            made[path, ranks] = cls(path, ranks)
        return made[path, ranks]

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken

        self.path = path
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        by_rank = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
        self.encode = by_rank.encode_ordinary
        self.words = _Words(self.encode)

    @cached_property
    def tokenizer(self):
        """Read when the first odd text comes up."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order and ``AT_ONCE`` texts at a time; null is empty."""
        for a in range(0, len(texts), AT_ONCE):
            yield from self._some(texts.slice(a, AT_ONCE))

    def forget(self) -> None:
        """Drop the words kept and hand back the memory Arrow has spare."""
        self.words.clear()
        pa.default_memory_pool().release_unused()

    def _some(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        # An odd text is left empty here and put in afterwards.
        plain = pc.if_else(pa.array(odd), "", texts)
        lists = pc.split_pattern(plain, " ")
        starts = np.asarray(lists.offsets)[:-1] - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        blocks = [self.words[w] for w in distinct]
        if len(self.words) > MOST:
            self.words.clear()
        # The first word of a text has no space before it.
        codes = coded.indices.to_numpy().astype(np.int64)
        firsts = [distinct[c] for c in codes[starts]]
        codes[starts] = len(blocks) + np.arange(len(starts))
        blocks += [_packed(self.encode(w)) for w in firsts]
        pool = np.frombuffer(b"".join(blocks), "<u4")
        lengths = np.array([len(b) for b in blocks], np.int64) // 4
        begins = np.cumsum(lengths) - lengths
        own = lengths[codes]
        ends = np.cumsum(own)
        ids = pool[np.arange(own.sum()) + np.repeat(begins[codes] - (ends - own), own)]
        cuts = (ends - own)[starts][1:]
        out = np.split(ids, cuts)
        for i in np.flatnonzero(odd):
            out[i] = self.whole(texts[int(i)].as_py())
        return out
