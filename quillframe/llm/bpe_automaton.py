"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that the merges produce. It
starts as one state with an arc for every base symbol. Merge by merge, in rank
order, a gadget is put in: if u and then v can be read, the state behind u is
replaced by a copy without the arc v, and every state with an arc u gets an arc
for the merged token to where v led. All arcs of a token lead to one state, so
a state is stored as the arcs it lost and when; whether it has an arc follows
from what it and the states it was copied from had lost at the time.

A word has one accepted path. It is walked from the left, the longest arc that
fits first, and steps back where no arc fits; prefixes known to be dead are not
entered again. Arc tests are kept in a table. Decoding emits the arcs' labels.
"""

from __future__ import annotations

import functools
import gc
import json
import re
import struct
import unicodedata

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_bounded, ddl, renamed, slices

#: Pairs of tokens whose transition a worker remembers; the table starts anew when full.
MEMORY = 400_000
#: Words, and runs between blanks, of which a worker remembers the encoding; when full, they become
#: the older half, from which those met again come back.
WORDS = 1 << 18
NEVER = float("inf")
END = "\n"

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACES = re.compile(f"[{_SPACE}]+")
#: Characters that Python splits at and the tokenizer's pattern does not.
_NOT_SPACE = re.compile("[\\x1c-\\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the rest from 256 on in order."""
    letters, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b:
            letters.append(chr(b))
        else:
            letters.append(chr(extra))
            extra += 1
    return letters


class Letters(dict):
    """The letters that may follow here, and the token that ends here, or -1."""

    __slots__ = ("token",)

    def __init__(self):
        self.token = -1


class Automaton:
    """The automaton of a vocabulary (token -> id) and its ranked merges.

    The state behind a token has lost the arcs of ``lost``, and those that the
    state it was copied from (that of the token's right part) had lost by then.
    """

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix, self.labels = suffix, {i: t for t, i in vocab.items()}
        made = {u + v for u, v in merges}
        self.ids = {t: i for t, i in vocab.items() if t not in made}
        self.lost: dict[tuple[int, int], int] = {}  # (token, arc): when the state behind the token lost the arc
        self.left: dict[int, tuple[tuple[int, float], ...]] = {i: ((i, NEVER),) for i in self.ids.values()}
        self.right = dict(self.left)
        for time, (one, two) in enumerate(merges):
            u, v, merged = vocab.get(one), vocab.get(two), vocab.get(one + two)
            if u not in self.left or v not in self.left or merged is None or merged in self.left:
                continue
            if not self.has(u, v):
                continue  # v never follows u, so the merge never applies
            # Every state with an arc u gets one for the merged token; it leads where v leads now.
            self.left[merged] = ((merged, NEVER), (u, time), *self.left[u][1:])
            self.right[merged] = ((merged, NEVER), (v, time), *self.right[v][1:])
            self.ids[one + two] = merged
            # The state behind u is replaced by its copy without the arc v.
            self.lost[u, v] = time
        self._table: dict[int, bool] = {}
        # The letters of all arcs as a tree; the word's end is a letter of its own.
        names = {t: n[: -len(suffix)] + END if suffix and n.endswith(suffix) else n for n, t in self.ids.items()}
        self.arcs = Letters()
        for token, name in names.items():
            node = self.arcs
            for letter in name:
                node = node.get(letter) or node.setdefault(letter, Letters())
            node.token = token
        self.length = {t: len(name) for t, name in names.items()}
        self.longest = max(self.length.values(), default=1)
        # The longest token that a token begins with, or -1.
        self.shorter = {}
        for token, name in names.items():
            node, self.shorter[token] = self.arcs, -1
            for letter in name[:-1]:
                node = node[letter]
                if node.token >= 0:
                    self.shorter[token] = node.token

    def has(self, before: int, token: int) -> bool:
        """Whether the state behind ``before`` has an arc for ``token``.

        The arc is lost if it was removed itself, or if the arc of its left part
        was gone when its gadget was built, and so on down both sides.
        """
        lost = self.lost
        for state, copied in self.right[before]:
            for arc, built in self.left[token]:
                time = lost.get((state, arc))
                if time is not None and time < copied and time <= built:
                    return False
        return True

    def follows(self, before: int, token: int) -> bool:
        key = before << 32 | token
        known = self._table.get(key)
        if known is None:
            if len(self._table) >= MEMORY:
                self._table.clear()
            known = self._table[key] = self.has(before, token)
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one pre-split word of byte letters."""
        root, longest, shorter, length, table = self.arcs, self.longest, self.shorter, self.length, self._table
        n = len(word)
        if self.suffix:
            word += END
        full, at, before = len(word), 0, -1
        path: list[int] = []
        dead: set[int] = {n} if self.suffix else set()
        while True:
            token, node = -1, root
            for letter in word[at : at + longest]:
                node = node.get(letter)
                if node is None:
                    break
                if node.token >= 0:
                    token = node.token
            while True:
                while token >= 0:
                    end = at + length[token]
                    if end not in dead:
                        if before < 0:
                            break
                        known = table.get(before << 32 | token)
                        if known or known is None and self.follows(before, token):
                            break
                    token = shorter[token]
                if token >= 0:
                    break
                dead.add(at)
                if not path:
                    raise ValueError(f"the vocabulary cannot write {word!r}")
                token = path.pop()
                at -= length[token]
                token = shorter[token]
                before = path[-1] if path else -1
            path.append(token)
            if end == full:
                return path
            at, before = end, token

    def decode(self, ids: list[int]) -> list[str]:
        return [self.labels[i] for i in ids]


class UnknownCharacter(Exception):
    """A character that this Python's Unicode tables do not know, so that its class is open."""


class WordTokenizer:
    """A tokenizer file of the kind: canonical composition, lower case, words split by a pattern, byte letters, word ends."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, bytes_step = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or bytes_step["type"] != "ByteLevel" or spec["decoder"]:
            raise ValueError(f"{path} is not a word tokenizer of the known kind")
        self.automaton = Automaton(model["vocab"], [tuple(m) for m in model["merges"]], model["end_of_word_suffix"] or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.automaton.labels.update({i: t for t, i in self.special.items()})
        self._marks = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._pattern = regex.compile(split["pattern"]["Regex"].replace(r"[^\s\p{L}\p{N}]", rf"[^{_SPACE}\p{{L}}\p{{N}}]"))
        self._letters = {i: c for i, c in enumerate(byte_letters())}
        # Tuples of numbers: small, and unlike lists, Python's collector stops walking them.
        self._words: dict[str, tuple[int, ...]] = {}
        self._chunks: dict[str, tuple[int, ...]] = {}
        self._older_words, self._older_chunks = {}, {}
        self._known: set[str] = set()  # characters met that are in the Unicode tables

    def _spelled(self, word: str) -> str:
        """The byte letters of a word; ASCII letters and digits stand for themselves."""
        return word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self._letters)

    def _word(self, word: str) -> tuple[int, ...]:
        found = self._words.get(word)
        if found is None:
            found = self._older_words.get(word) or tuple(self.automaton.encode(self._spelled(word)))
            if len(word) < 64:
                if len(self._words) >= WORDS:
                    self._older_words = self._words.copy()
                    self._words.clear()
                self._words[word] = found
        return found

    def _split(self, text: str) -> list[str]:
        if not text.isascii():
            new = set(text) - self._known
            if any(unicodedata.category(c) == "Cn" for c in new):
                raise UnknownCharacter
            self._known |= new
        return self._pattern.findall(text)

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        """Ids of a piece without white space that is not among the newer ones."""
        found = self._older_chunks.get(chunk) or self._made(chunk)
        if len(chunk) < 64:
            if len(self._chunks) >= WORDS:
                self._older_chunks = self._chunks.copy()
                self._chunks.clear()
            self._chunks[chunk] = found
        return found

    def _made(self, chunk: str) -> tuple[int, ...]:
        text = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
        # Every character is lower-cased for itself; a whole word would get a final sigma.
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        words = [text] if text.isascii() and text.isalpha() else self._split(text)
        return self._word(words[0]) if len(words) == 1 else tuple(i for w in words for i in self._word(w))

    def _written(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), " ".join(map(self.automaton.labels.__getitem__, ids))

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and the decoded text: labels joined by blanks."""
        try:
            return self._encode(text)
        except UnknownCharacter:
            # Only texts with such characters go to the file's own library.
            return self._written(self._library.encode(text, add_special_tokens=False).ids)

    @functools.cached_property
    def _library(self):
        import tokenizers

        library = tokenizers.Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def _encode(self, text: str) -> tuple[bytes, str]:
        ids: list[int] = []
        known = self._chunks.get
        for part in self._marks.split(text) if self._marks and "<" in text else (text,):
            if part in self.special:
                ids.append(self.special[part])
                continue
            for chunk in part.split() if not _NOT_SPACE.search(part) else _SPACES.split(part):
                ids += known(chunk) or self._chunk(chunk)
        return self._written(ids)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One automaton per worker process and file.

    A worker collects its garbage after each task, of whatever query. The automaton is
    hundreds of thousands of objects that stay, so they are taken out of the collector's reach.
    """
    made = WordTokenizer(path)
    gc.collect()
    gc.freeze()
    return made


def encode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``n_tokens``, ``ids`` (packed little-endian unsigned 32-bit integers) and ``decoded`` to every row.

    A null or empty text has no tokens and decodes to an empty text. Clashing columns are replaced.
    """
    arrow_bounded(df.sparkSession)
    rows = renamed(df, ["n_tokens", "ids", "decoded"])
    columns = rows.columns

    def run(batches):
        encoder = tokenizer(path)
        for batch in batches:
            for part in slices(batch, text):
                ids, decoded = zip(*(encoder.encode(t or "") for t in part.column(text).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    [*columns, "n_tokens", "ids", "decoded"],
                )

    return rows.mapInArrow(run, f"{ddl(rows)}, n_tokens bigint, ids binary, decoded string")
