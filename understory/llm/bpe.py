"""BPE encoding and decoding with a trie that shares the work of common prefixes.

The distinct words of a block of texts go into one trie of bytes. A depth-first walk gives each node the *last token*
of the encoding of its prefix: the one token that ends there and is compatible with the last token of the shorter
prefix before it (two tokens are compatible if BPE of their joined symbols gives just those two). Prefixes that many
words share are so encoded once. A word's end is a symbol of its own kind (its last byte with the end mark), tried at
the node below. Words already seen stay in a bounded dictionary of their finished ids.

Defined results: null texts count as empty (no tokens, empty decoding); texts are encoded whole; special-token
strings in a text become their ids; repeated rows repeat; an empty table gives an empty table; only ``id_col`` and
``text_col`` are read.
"""

from __future__ import annotations

import gc
import json
import re
import struct
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_texts, table

#: White space as Unicode has it.
_SPACE = "\t-\r \x85\xa0  -     　"
_WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: The same for lower-case ASCII.
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
#: Finished words of a generation (two are kept by a Python worker) and pairs of tokens, characters of text whose new words share a trie.
KEEP, FITS, BLOCK = 100_000, 150_000, 1 << 19
ENDS = [bytes([b]) for b in range(256)]


def byte_letters() -> list[str]:
    """The printable letter for each byte: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class TrieBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, self.end = spec["model"], spec["model"]["end_of_word_suffix"]
        back = {c: b for b, c in enumerate(byte_letters())}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special_re = re.compile("|".join(re.escape(x) for x in sorted(self.special, key=len, reverse=True)))
        self.text = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for t, i in model["vocab"].items():
            last = t.endswith(self.end) and t != self.end
            raw = t[: -len(self.end)] if last else t
            if t not in self.special and all(c in back for c in raw):
                (self.final if last else self.inner)[bytes(back[c] for c in raw)] = i
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y, z = model["vocab"][a], model["vocab"][b], model["vocab"][a + b]
            self.merge[x, y] = (rank, z)
            self.made.setdefault(z, (x, y))
        self.rank = {i: self.merge[self.made[i]][0] if i in self.made else -1 for i in self.text}
        self.inner = {t: i for t, i in self.inner.items() if self.reachable(i)}
        self.final = {t: i for t, i in self.final.items() if self.reachable(i)}
        self.inner_reach, self.final_reach = self.reach(self.inner), self.reach(self.final)
        self.fits: dict[int, bool] = {}
        self.ids: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def reach(tokens: dict[bytes, int]) -> dict[bytes, int]:
        """The length of the longest token that ends in these three bytes."""
        out: dict[bytes, int] = {}
        for t in tokens:
            if len(t) > 2 and len(t) > out.get(t[-3:], 0):
                out[t[-3:]] = len(t)
        return out

    def crossing_free(self, a: int, b: int) -> bool:
        """Does BPE of the joined symbols of tokens a and b leave both as they are?

        Undo the latest merge of either side again and again, down to single symbols. A merge across the border spoils
        the pair if it ranks before the merge just undone; of equal ranks the leftmost goes first.
        """
        limit, rank, made = 1 << 30, self.rank, self.made
        while True:
            across = self.merge.get((a, b))
            if across is not None and across[0] < limit:
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, made[a][1]
            else:
                limit, b = rb + 1, made[b][0]

    def reachable(self, t: int) -> bool:
        """Does BPE of t's own symbols end in t? Its two parts must stand beside each other until they merge."""
        while t in self.made:
            a, b = self.made[t]
            limit = self.rank[t]
            if self.rank[a] > limit or self.rank[b] > limit:
                return False
            return self.beside(a, b, limit) and self.reachable(a) and self.reachable(b)
        return True

    def beside(self, a: int, b: int, limit: int) -> bool:
        """crossing_free() but for the merge of rank limit itself."""
        made = self.merge.pop((a, b))
        try:
            return self.crossing_free(a, b)
        finally:
            self.merge[a, b] = made

    def words(self, words: set[bytes]) -> dict[bytes, list[int]]:
        """The ids of each distinct word, from one trie.

        A node is [its children, the last bytes of words that end below it]. On the way down, last[d] and lens[d] are
        the last token of the path's first d bytes and its length.
        """
        root: list = [{}, []]
        for w in words:
            node = root
            for b in w[:-1]:
                kids = node[0]
                node = kids.get(b)
                if node is None:
                    node = kids[b] = [{}, []]
            node[1].append(w[-1])
        out: dict[bytes, list[int]] = {}
        last, lens = [-1], [0]
        stack: list[tuple[bytes, list]] = [(b"", root)]
        inner, final, fits, free = self.inner.get, self.final.get, self.fits, self.crossing_free
        inner_reach, final_reach = self.inner_reach.get, self.final_reach.get
        if len(fits) > FITS:
            fits.clear()
        while stack:
            path, node = stack.pop()
            depth = len(path)
            if depth:
                for k in range(depth if depth < 3 else min(depth, inner_reach(path[-3:], 2)), 0, -1):
                    if (t := inner(path[depth - k :])) is not None:
                        a = last[depth - k]
                        if a < 0:
                            break
                        if (ok := fits.get(key := a << 16 | t)) is None:
                            ok = fits[key] = free(a, t)
                        if ok:
                            break
                else:
                    raise ValueError(f"no token ends {path!r}")
                last[depth:], lens[depth:] = (t,), (k,)
            for end in node[1]:
                whole = path + ENDS[end]
                n = depth + 1
                for k in range(n if n < 3 else min(n, final_reach(whole[-3:], 2)), 0, -1):
                    if (t := final(whole[n - k :])) is not None:
                        a = last[n - k]
                        if a < 0:
                            break
                        if (ok := fits.get(key := a << 16 | t)) is None:
                            ok = fits[key] = free(a, t)
                        if ok:
                            break
                else:
                    raise ValueError(f"no token ends {whole!r}")
                ids, at = [t], n - k
                while at > 0:
                    ids.append(last[at])
                    at -= lens[at]
                ids.reverse()
                out[whole] = ids
            for c, child in node[0].items():
                stack.append((path + ENDS[c], child))
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words that aren't known yet."""
        if len(self.ids) > KEEP:  # of the words before, those that are met again come back
            self.old, self.ids = self.ids, {}
        new = words - self.ids.keys()
        again = new & self.old.keys()
        self.ids.update((w, self.old[w]) for w in again)
        new = {w.encode() for w in new - again}
        gc.disable()  # a trie has many containers and no cycles
        try:
            for w, ids in self.words(new).items():
                self.ids[w.decode()] = struct.pack(f"<{len(ids)}I", *ids)
        finally:
            gc.enable()

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if text.isascii():
            return _ASCII.findall(text.lower())
        return _WORD.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def pieces(self, text: str) -> list[list[str] | str]:
        """Lists of words, and special tokens between them."""
        if "<|" not in text or not self.special_re.search(text):
            return [self.split(text)]
        out, at = [], 0
        for m in self.special_re.finditer(text):
            out += [self.split(text[at : m.start()]), m[0]]
            at = m.end()
        return [*out, self.split(text[at:])]

    def finish(self, pieces: list[list[str] | str]) -> bytes:
        ids = self.ids.__getitem__
        return b"".join(struct.pack("<I", self.special[p]) if isinstance(p, str) else b"".join(map(ids, p)) for p in pieces)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        out, block, size = [], [], 0
        for t in [*texts, None]:
            if t is None or size > BLOCK:
                self.learn({w for ps in block for p in ps if not isinstance(p, str) for w in p})
                out += [self.finish(ps) for ps in block]
                block, size = [], 0
            if t is not None:
                block.append(self.pieces(t))
                size += len(t)
        return out

    def decode(self, ids: bytes) -> str:
        """Without a decoder in the file, tokens are joined by spaces."""
        return " ".join(map(self.text.__getitem__, memoryview(ids).cast("I")))


@lru_cache(2)
def tokenizer(path: str) -> TrieBPE:
    """Read once by each Python worker."""
    return TrieBPE(path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def bpe_encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row for each input row: its id, ``ids`` (little-endian 32-bit integers, binary), ``decoded``. Narrow."""
    path = path or default_path()

    def run(batches):
        bpe = tokenizer(path)
        for b in batches:
            ids = bpe.encode([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())], ["id", "ids", "decoded"])
        bpe.ids, bpe.old, bpe.fits = {}, {}, {}

    return map_texts(df.select(id_col, text_col), run, f"id {dict(df.dtypes)[id_col]}, ids binary, decoded string").withColumnRenamed("id", id_col)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.selectExpr("doc_id", "cast(octet_length(ids) div 4 as bigint) as n_tokens", "sha2(ids, 256) as ids_sha256", "sha2(decoded, 256) as decoded_sha256")


def op9_bpe(spark, sf_dir):
    return digests(bpe_encode(table(spark, sf_dir, "documents")))

