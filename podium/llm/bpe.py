"""BPE encoding and decoding with a pair occurrence index.

A task lays out the symbols of all distinct words it has not met yet in one
flat linked list and maps every mergeable pair to all its positions there. The
active ranks are applied in ascending order: the lowest one merges at all its
positions, left to right, and only the lists of the pairs to the left and
right of a merge change. Words then carry their ids to every text they are in.

The vocabulary file is a parameter; the driver reads it and broadcasts the
vocabulary, whose size is fixed by the file.
"""
from __future__ import annotations

import gc
import hashlib
import heapq
import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import distinct_spans, documents, map_arrow, mix64, span_hashes

#: Words whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 500_000
#: Words indexed together, and code points split together.
INDEXED = 50_000
PASS_CHARS = 1 << 20
#: Code points whose class the driver asks for at a time.
CLASS_POINTS = 1 << 12
_LETTER, _NUMBER, _OTHER = 1, 2, 3
# Fixed value: the split pattern that this encoder follows.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the rest follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


def read_vocabulary(path: str) -> dict:
    """The parts of a tokenizer file that this operator needs, checked for the kind it handles."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or spec["decoder"] is not None \
            or not split["invert"] or split["pattern"]["Regex"] != PATTERN:
        raise ValueError("not a word-end BPE vocabulary of the known split, without decoder")
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": vocab, "merges": [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges],
            "special": {t["content"]: t["id"] for t in spec["added_tokens"]}, "name": f"{path}:{len(merges)}", "classes": _classes()}


def _classes() -> bytes:
    """Per code point: 0 blank, letter, number or other, by the tables of the
    library's own pattern engine (Unicode versions differ in newer signs)."""
    from tokenizers import Regex, pre_tokenizers
    out = np.full(0x110000, _OTHER, np.uint8)
    kinds = [(kind, pre_tokenizers.Split(Regex(f"(?:{pattern})+"), "removed", invert=True))
             for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (0, r"\s"))]
    # the library keeps many bytes per sign of what it splits, so the tables are asked in short stretches
    for first in range(0, 0x110000, CLASS_POINTS):
        text = "".join(chr(c) for c in range(first, first + CLASS_POINTS) if not 0xD800 <= c < 0xE000)
        for kind, split in kinds if text else ():
            for run, _ in split.pre_tokenize_str(text):
                out[[ord(c) for c in run]] = kind
    return out.tobytes()


def split_words(points: np.ndarray, cuts: np.ndarray, classes: np.ndarray):
    """(starts, ends, row) of the words of lower-cased rows laid end to end:
    runs of letters, single numbers, runs of other signs, and contractions."""
    n = len(points)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    k = classes[points]
    new = np.empty(n, bool)
    new[0] = True
    new[1:] = (k[1:] != k[:-1]) | (k[1:] == _NUMBER)
    new[cuts[:-1][cuts[:-1] < n]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], n)
    row = np.searchsorted(cuts, starts, "right") - 1
    # a lone apostrophe takes s, t, m, d, re, ve or ll from the letters behind it
    lone = np.flatnonzero((points[starts] == 39) & (ends - starts == 1))
    lone = lone[lone + 1 < len(starts)]
    lone = lone[(row[lone + 1] == row[lone]) & (k[starts[lone + 1]] == _LETTER)]
    if len(lone):
        i = starts[lone + 1]
        one = points[i]
        two = np.where(ends[lone + 1] - i > 1, points[np.minimum(i + 1, n - 1)], 0)
        take = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        take[pair] = 2
        ends[lone] += take
        starts[lone + 1] += take
    ok = (k[np.minimum(starts, n - 1)] != 0) & (starts < ends)
    return starts[ok], ends[ok], row[ok]


_ENCODERS: dict[str, Encoder] = {}


def encoder(spec: dict) -> Encoder:
    """One encoder per vocabulary and worker, so that what it has learned serves later tasks."""
    if spec["name"] not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[spec["name"]] = Encoder(spec)
    return _ENCODERS[spec["name"]]


class Encoder:
    def __init__(self, spec: dict):
        sym, vocab = byte_symbols(), spec["vocab"]
        self.name = {i: t.encode() for t, i in vocab.items()}
        self.inner = [vocab[s] for s in sym]
        self.last = [vocab[s + "</w>"] for s in sym]
        self.by_rank = spec["merges"]
        self.merge: dict[int, int] = {}
        for rank, (a, b, _) in enumerate(self.by_rank):
            self.merge.setdefault(a << 20 | b, rank)
        self.classes = np.frombuffer(spec["classes"], np.uint8)
        self.newer = np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), bool, 0x110000)
        self.special = {t: (struct.pack("<I", i), t.encode()) for t, i in spec["special"].items()}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(spec["special"], key=len, reverse=True)) + ")") \
            if spec["special"] else None
        self.known: dict[bytes, tuple[bytes, bytes]] = {}    # by the word in UTF-32

    def parts(self, text: str) -> list[str]:
        """Text and special tokens in turn: special tokens are cut out first."""
        return self.cut.split(text) if self.cut and "<|" in text else [text]

    @staticmethod
    def normal(text: str) -> str:
        """NFC, then lower case character by character (no final sigma)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        return text.lower()

    def encode_batch(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Per text its ids as little-endian unsigned 32-bit integers, and its
        decoding in UTF-8. Without a decoder the file's decoding joins token
        names with blanks."""
        plan = [self.parts(t) for t in texts]
        rows = [self.normal(p) for parts in plan for p in parts[::2]]
        points = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32)
        if self.newer[points].any():            # signs newer than Python's tables: the library's normaliser knows them
            from tokenizers import normalizers
            own = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
            rows = [own.normalize_str(p) for parts in plan for p in parts[::2]]
            points = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32)
        cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
        starts, ends, row = split_words(points, cuts, self.classes)
        if len(starts):
            codes = mix64(points.astype(np.uint64) + np.uint64(1))
            first, back = distinct_spans(points, span_hashes(codes, starts, ends), starts, ends)
            keys = [points[a:z].tobytes() for a, z in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            if len(self.known) > REMEMBERED:
                self.known.clear()
            new = [w for w in keys if w not in self.known]
            gc.disable()                        # the index holds no cycles, only many small lists
            for i in range(0, len(new), INDEXED):
                self._index(new[i:i + INDEXED])
            gc.enable()
            got = [self.known[w] for w in keys]
            ids, names = [g[0] for g in got].__getitem__, [g[1] for g in got].__getitem__
        at = np.searchsorted(row, np.arange(len(rows) + 1)).tolist()
        out, r = [], 0
        for parts in plan:
            raw, text = [], []
            for k, part in enumerate(parts):
                if k % 2:
                    raw.append(self.special[part][0])
                    text.append(self.special[part][1])
                    continue
                if at[r] < at[r + 1]:
                    words = back[at[r]:at[r + 1]].tolist()
                    raw.append(b"".join(map(ids, words)))
                    text.append(b" ".join(map(names, words)))
                r += 1
            out.append((b"".join(raw), b" ".join(text)))
        return out

    def _index(self, keys: list[bytes]) -> None:
        sym: list[int] = []
        ends = []
        for w in keys:
            raw = w.decode("utf-32-le").encode()
            sym += [self.inner[b] for b in raw[:-1]]
            sym.append(self.last[raw[-1]])
            ends.append(len(sym))
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        for e in ends:
            nxt[e - 1] = -1
            if e < n:
                prv[e] = -1
        merge = self.merge
        where: dict[int, list[int]] = {}        # rank -> positions of its pair
        for i in range(n):
            j = nxt[i]
            if j >= 0:
                r = merge.get(sym[i] << 20 | sym[j])
                if r is not None:
                    where.setdefault(r, []).append(i)
        active = list(where)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            a, b, new = self.by_rank[rank]
            for i in sorted(where.pop(rank)):
                j = nxt[i]
                if sym[i] != a or j < 0 or sym[j] != b:
                    continue                    # an overlapping merge took a part of it
                sym[i], sym[j] = new, -1
                k = nxt[i] = nxt[j]
                if k >= 0:
                    prv[k] = i
                    r = merge.get(new << 20 | sym[k])
                    if r is not None:
                        if r not in where:
                            where[r] = []
                            heapq.heappush(active, r)
                        where[r].append(i)
                p = prv[i]
                if p >= 0:
                    r = merge.get(sym[p] << 20 | new)
                    if r is not None:
                        if r not in where:
                            where[r] = []
                            heapq.heappush(active, r)
                        where[r].append(p)
        begin = 0
        name = self.name
        for w, e in zip(keys, ends, strict=True):
            ids = [x for x in sym[begin:e] if x >= 0]
            self.known[w] = (struct.pack(f"<{len(ids)}I", *ids), b" ".join([name[x] for x in ids]))
            begin = e


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True,
               decoded: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row, with ``ids``
    (array of token ids) and ``decoded`` (text) as asked, and the columns of
    ``carry`` as they are.

    Null counts as empty: no ids, empty decoding. Repeated rows give repeated
    results, an empty table an empty one. Texts are encoded whole.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(read_vocabulary(path))
    kinds = dict(docs.dtypes)
    schema = "".join(f"`{c}` {kinds[c]}, " for c in carry) + \
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + \
        (", ids array<int>" if ids else "") + (", decoded string" if decoded else "")

    names = [*carry, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids + ["decoded"] * decoded

    def run(batches):
        enc = encoder(shared.value)
        for batch in batches:
            texts, done = batch.column(len(carry) + 1), 0
            while done < batch.num_rows:
                group, size = [], 0             # the distinct words of many texts share one index
                while done + len(group) < batch.num_rows and size < PASS_CHARS:
                    group.append(texts[done + len(group)].as_py() or "")
                    size += len(group[-1])
                rows = enc.encode_batch(group)
                part = batch.slice(done, len(group))
                cols = [part.column(i) for i in range(len(carry) + 1)]
                counts = np.array([len(r[0]) // 4 for r in rows], np.int64)
                cols += [pa.array(counts), pa.array([hashlib.sha256(r[0]).hexdigest() for r in rows], pa.string()),
                         pa.array([hashlib.sha256(r[1]).hexdigest() for r in rows], pa.string())]
                if ids:
                    flat = np.frombuffer(b"".join(r[0] for r in rows), np.int32)
                    off = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(off), pa.array(flat)))
                if decoded:
                    cols.append(pa.array([r[1].decode() for r in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names)
                done += len(group)

    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in carry], F.col(id_col).cast("long").alias("doc_id"),
                                 F.col(text_col).alias("__bpe_text")), run, schema)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(documents(spark, sf_dir), default_path(), ids=False)


QUERIES = {"op7_bpe": op7_bpe}
SQL: dict[str, str] = {}
