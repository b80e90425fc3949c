"""Byte-pair encoding by dynamic programming over prefixes, and decoding."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import released, slices

#: Stands after a word's last character, where the vocabulary writes the word-end suffix.
END = "\n"
#: Words whose encoding is kept in each of two generations; when one is full, the older goes. Some 100 MB for each generation.
CACHE = 300_000
#: Of them, and of pieces and tested pairs, what an idle worker keeps from one task to the next: the first that it met, some 40 MB.
IDLE = 100_000
#: Characters of a text that are normalised at once.
PIECE = 1 << 20
#: The normaliser and splitter for which the short way below holds. Of any other file, every text goes whole to the library's.
SHORT_FORM = (
    {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
#: Text whose normal form is its lower case and whose words PLAIN_WORDS finds; any other goes to the library's normaliser and splitter.
PLAIN = re.compile(r"[\t-\r -~\u00c0-\u012f\u0132-\u017f]*")
PLAIN_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


def byte_letters() -> list[str]:
    """The printable letter of each byte: printable Latin-1 stands for itself, the others follow from 256 up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


#: Ids in decimal, decoded text, number of ids.
Part = tuple[str, str, int]


class Known(dict):
    """What make gives for a word, kept for two generations of words."""

    def __init__(self, make: Callable[[str], Part]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, word: str) -> Part:
        found = self.older.get(word) or self.make(word)
        if len(self) >= CACHE:
            self.older = dict(self)
            self.clear()
        self[word] = found
        return found


class WordBpe:
    """A tokenizer file's BPE model, each word encoded by its prefixes.

    Byte-pair merging gives every prefix of a word one last token. The automaton names all vocabulary tokens that are
    suffixes of each prefix. Of these, the last token is the one that may stand after the last token of what
    remains in front of it: two neighbours are compatible if merging their joined symbols yields just the two. Back-pointers then
    give the ids of the word.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self._check(spec)
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.text = {i: t for t, i in self.ids.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        most = max(self.text) + 1
        self.merged: list[dict[int, int]] = [{} for _ in range(most)]
        #: A token's merge, -1 where none makes it, and the two tokens merged.
        self.age, self.left_half, self.right_half = [-1] * most, [0] * most, [0] * most
        for n, pair in enumerate(model["merges"]):
            a, b = (self.ids[x] for x in (pair if isinstance(pair, list) else pair.split(" ")))
            made = self.ids["".join(pair) if isinstance(pair, list) else pair.replace(" ", "")]
            self.merged[a].setdefault(b, made)
            if self.age[made] < 0:
                self.age[made], self.left_half[made], self.right_half[made] = n, a, b
        self.specials = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        #: What every added token begins with; a text without it holds none.
        self.sign = os.path.commonprefix(list(self.added))
        self.short = (spec["normalizer"], spec["pre_tokenizer"]) == SHORT_FORM
        self.joined = spec["decoder"] is None
        # Where the library only normalises and splits, its copy of the vocabulary isn't needed.
        self.library = Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "model": model | {"vocab": {}, "merges": []}})) if self.joined else Tokenizer.from_file(path)
        self.letters = byte_letters()
        self._build()
        self.pairs: list[dict[int, bool]] = [{} for _ in range(max(self.text) + 1)]
        self.tested = 0
        self.pieces: dict[str, list[int]] = {}
        self.known = Known(self._word)

    @staticmethod
    def _check(spec: dict) -> None:
        """Raises where the file asks for something that the prefixes don't give."""
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [f"added token {t['content']!r}: {k}" for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized") if t[k]]
        if model.get("type", "BPE") != "BPE" or odd:
            raise ValueError(f"tokenizer files with these settings aren't supported: {model.get('type')}, {', '.join(odd)}")

    def forget(self) -> None:
        """Drops most of what was kept of the texts so far; what is met first is what is common."""
        words = dict(islice(chain(self.known.older.items(), self.known.items()), IDLE))
        self.known.clear()
        self.known.older = {}
        self.known.update(words)
        self.pieces = dict(islice(self.pieces.items(), IDLE))
        if self.tested > 4 * IDLE:
            self._forget_pairs()

    def _forget_pairs(self) -> None:
        self.tested = 0
        for some in self.pairs:
            some.clear()

    def _build(self) -> None:
        """The automaton: its state after each prefix is the longest vocabulary path that is a suffix of the prefix.

        best: the longest token that is a suffix of a state's path; shorter: the next shorter one that is.
        """
        size, suffix = {}, self.suffix
        self.children: list[dict[str, int]] = [{}]
        own: dict[int, int] = {}
        for token, i in self.ids.items():
            ends = bool(suffix) and token.endswith(suffix) and token != suffix
            shape = token[: -len(suffix)] + END if ends else token
            size[i] = len(shape) - ends
            state = 0
            for c in shape:
                below = self.children[state]
                if c not in below:
                    below[c] = len(self.children)
                    self.children.append({})
                state = below[c]
            own[state] = i
        self.fail, self.best, self.shorter = [0] * len(self.children), [-1] * len(self.children), {}
        queue = deque([0])
        while queue:
            state = queue.popleft()
            for c, to in self.children[state].items():
                back = self.fail[state]
                while back and c not in self.children[back]:
                    back = self.fail[back]
                self.fail[to] = self.children[back].get(c, 0) if state else 0
                under = self.best[self.fail[to]]
                if to in own:
                    self.best[to], self.shorter[own[to]] = own[to], under
                else:
                    self.best[to] = under
                queue.append(to)
        self.size = [size.get(i, 0) for i in range(max(self.text) + 1)]
        #: Steps known so far: a state's children, and what its failure links gave. A state that fails to another goes where that one goes.
        self.go, self.children = self.children, []

    def _step(self, state: int, c: str) -> int:
        at = state
        while at and c not in self.go[at]:
            at = self.fail[at]
        found = self.go[state][c] = self.go[at].get(c, 0)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging left's and right's symbols, side by side, ends in left and right.

        The younger of the two tokens facing each other is taken apart step by step. At every step the pair at the
        border must not merge earlier than the merges that built what stands there.
        """
        found = self.pairs[right].get(left)
        if found is None:
            found = self.pairs[right][left] = self._apart(left, right)
            self.tested += 1
            if self.tested > 4 * CACHE:
                self._forget_pairs()
        return found

    def _apart(self, left: int, right: int) -> bool:
        age, merged, left_half, right_half = self.age, self.merged, self.left_half, self.right_half
        #: Merges at the border that come before this one would have been made; on equal merges the leftmost wins.
        bound = 1 << 60
        while True:
            made = merged[left].get(right)
            if made is not None and age[made] < bound:
                return False
            a, b = age[left], age[right]
            if a > b:
                bound, left = a, right_half[left]
            elif b >= 0:
                bound, right = b + 1, left_half[right]
            else:
                return True

    def encode_word(self, word: str) -> list[int]:
        """Ids of one pre-tokenized word, given in byte letters."""
        if not word:
            return []
        last, start, to = [0], [0], 0
        go, best, size, shorter, pairs = self.go, self.best, self.size, self.shorter, self.pairs
        state, n = 0, len(word)
        for c in word:
            to += 1
            after = go[state].get(c)
            state = self._step(state, c) if after is None else after
            token = best[state]
            if to == n and self.suffix:
                after = go[state].get(END)
                token = best[self._step(state, END) if after is None else after]
            while token >= 0:
                front = to - size[token]
                if not front:
                    break
                ok = pairs[token].get(last[front])
                if ok or ok is None and self.compatible(last[front], token):
                    break
                token = shorter[token]
            else:
                raise ValueError(f"the vocabulary can't spell {word[:40]!r}")
            last.append(token)
            start.append(front)
        out = [last[-1]]
        to = start[-1]
        while to:
            out.append(last[to])
            to = start[to]
        out.reverse()
        return out

    def _piece(self, piece: str, spelt: bool) -> list[int]:
        key = END + piece if spelt else piece
        found = self.pieces.get(key)
        if found is None:
            found = self.encode_word(piece if spelt or piece.isascii() else "".join([self.letters[b] for b in piece.encode("utf-8")]))
            if len(self.pieces) >= CACHE:
                self.pieces.clear()
            self.pieces[key] = found
        return found

    def _word(self, word: str) -> Part:
        """A run of anything but white space, in lower case."""
        return self._part([i for piece in PLAIN_WORDS.findall(word) for i in self._piece(piece, False)])

    def _part(self, ids: list[int]) -> Part:
        return " ".join(map(str, ids)), " ".join([self.text[i] for i in ids]), len(ids)

    def _words(self, text: str) -> list[Part]:
        if not self.short:
            normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
            spelt = self.library.pre_tokenizer.pre_tokenize_str(normal) if self.library.pre_tokenizer else [(normal, None)]
            return [self._part(self._piece(word, True)) for word, _ in spelt if word]
        if PLAIN.fullmatch(text):
            return list(map(self.known.__getitem__, text.lower().split()))
        out: list[Part] = []
        for line in text.split("\n"):
            if PLAIN.fullmatch(line):
                out += map(self.known.__getitem__, line.lower().split())
            else:
                spelt = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(line))
                out += [self._part(self._piece(word, True)) for word, _ in spelt]
        return out

    def _pieces(self, text: str) -> Iterator[str]:
        """A long text in pieces cut before a space, where no word, composition or run of white space goes on."""
        at = 0
        while self.short and len(text) - at > PIECE:
            cut = text.find(" ", at + PIECE)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:] if at else text

    def parts(self, text: str) -> Iterator[list[Part]]:
        """Ids, decoded text and count of each word and special token, in order, some at a time."""
        at = 0
        for m in [*self.specials.finditer(text), None] if self.sign in text else [None]:
            for piece in self._pieces(text[at : m.start()] if m else text[at:] if at else text):
                yield self._words(piece)
            if m:
                yield [(str(self.added[m.group()]), m.group(), 1)]
                at = m.end()

    def encode(self, text: str) -> list[int]:
        return [int(i) for some in self.parts(text) for part in some if part[2] for i in part[0].split(" ")]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by one space where the tokenizer file names no decoder, else by that; unknown ids are left out."""
        if not self.joined:
            return self.library.decode(ids, skip_special_tokens=False)
        return " ".join(self.text[i] for i in ids if i in self.text)

    def digest(self, text: str) -> tuple[int, str, str]:
        """Count of ids, SHA-256 of the ids in decimal, and SHA-256 of the text that they decode to."""
        if not self.joined:
            own = self.encode(text)
            return len(own), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, own)), self.decode(own)))
        n, ids, decoded = 0, hashlib.sha256(), hashlib.sha256()
        for some in self.parts(text):
            if not some:
                continue
            gap = " " if n else ""
            ids.update((gap + " ".join([p[0] for p in some])).encode())
            decoded.update((gap + " ".join([p[1] for p in some])).encode())
            n += sum([p[2] for p in some])
        return n, ids.hexdigest(), decoded.hexdigest()


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    """The tokenizer at path, once for each Python worker, which keeps the one last used."""
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' ids with n_tokens and ids array<int>. path must be readable on every executor. Null counts as empty."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = loaded(path)
        for texts in batches:
            yield pd.Series([own.encode(t or "") for t in texts])
        own.forget()
        released()

    return docs.select(F.col(id_col), ids(F.col(text_col)).alias("ids")).select(id_col, F.size("ids").cast("long").alias("n_tokens"), "ids")


def bpe_decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """encoded with a column decoded, special tokens included; null ids give an empty text."""

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = loaded(path)
        for some in batches:
            yield pd.Series([own.decode([] if i is None else list(i)) for i in some])

    return encoded.withColumn("decoded", text(F.col(ids_col)))


def bpe_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256.

    What encode and decode give, without sending the ids out of the worker. Null and empty texts have no ids
    and the digest of nothing. Very long texts are worked through in pieces; repeated rows each return.
    """

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = loaded(path)
        for batch in batches:
            found = [own.digest(t or "") for texts in slices(batch) for t in texts]
            columns = [pa.array([r[k] for r in found], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.StructArray.from_arrays(columns, ["n_tokens", "ids_sha256", "decoded_sha256"])
        own.forget()
        released()

    return docs.select(F.col(id_col), digests(F.col(text_col)).alias("_d")).select(id_col, "_d.*")
