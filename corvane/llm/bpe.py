"""Byte-level BPE encoding and decoding, as the `tokenizers` library does it, from a public vocabulary file.

A text is split at the strings of special tokens, then into pre-tokens by the byte-level pattern; a file that asks for another
pattern, a normaliser or special tokens that strip is refused. Each distinct
pre-token of a worker is merged once and kept in a cache of bounded size. Merging holds the ranks of adjacent parts in
one contiguous array: scan it for the least rank, delete the boundary between those two parts, refresh the two neighbouring
ranks, and repeat. A scan for each merge is quadratic, so pre-tokens of more than `LONG` bytes take the
same steps from a heap over linked parts, which gives the same result in n log n.

Decoding looks the ids' byte strings up, joins them and reads them as UTF-8, invalid bytes becoming U+FFFD.

Defined cases: null text is encoded as the empty one (no ids); a text is encoded whole at any length;
repeated rows are encoded one by one; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import documents, ship

#: The splitting pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONG = 64
CACHE_WORDS = 250_000
CACHED_BYTES = 64
NONE = 1 << 60


def _alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _refuse_others(j: dict) -> None:
    """Raises for a file that asks for more than a byte-level BPE does here: PATTERN is what its pre-tokenizer uses, and special tokens are plain strings."""
    before, model = j.get("pre_tokenizer") or {}, j["model"]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not j.get("normalizer") and (j.get("decoder") or {}).get("type") == "ByteLevel"
    plain = plain and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if not plain or any(t.get(k) for t in j.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("not a plain byte-level BPE file")


class Codec:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            j = json.load(f)
        _refuse_others(j)
        model, known = j["model"], _alphabet()
        raw = lambda s: bytes(known[c] for c in s)
        self.ids = {raw(s): i for s, i in model["vocab"].items()}
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merges[(self.ids[raw(a)], self.ids[raw(b)])] = (rank, self.ids[raw(a + b)])
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for s, i in [*self.ids.items(), *((s.encode(), i) for s, i in self.special.items())]:
            self.bytes[i] = s
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.cache: dict[str, bytes] = {}

    def merge_short(self, word: bytes) -> list[int]:
        merges = self.merges
        parts = [self.single[b] for b in word]
        none = (NONE, -1)
        ranks = [merges.get(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best[0] == NONE:
                break
            i = ranks.index(best)
            parts[i] = best[1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = merges.get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = merges.get((parts[i - 1], parts[i]), none)
        return parts

    def merge_long(self, word: bytes) -> list[int]:
        merges, n = self.merges, len(word)
        parts, left, right = [self.single[b] for b in word], list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m[0], i, parts[i], parts[i + 1], m[1]) for i in range(n - 1) if (m := merges.get((parts[i], parts[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, to = heapq.heappop(heap)
            j = right[i] if parts[i] == a else -1
            if j < 0 or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j], right[i] = to, -1, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y >= 0 and (m := merges.get((parts[x], parts[y]))):
                    heapq.heappush(heap, (m[0], x, parts[x], parts[y], m[1]))
        return [p for p in parts if p >= 0]

    def word(self, w: str) -> bytes:
        """The ids of a pre-token as little-endian unsigned 32-bit integers."""
        raw = w.encode("utf-8")
        whole = self.ids.get(raw) if len(raw) == 1 else None
        ids = [whole] if whole is not None else self.merge_short(raw) if len(raw) <= LONG else self.merge_long(raw)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(raw) <= CACHED_BYTES:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            self.cache[w] = packed
        return packed

    def encode(self, text: str) -> bytes:
        get, word, find, out = self.cache.get, self.word, self.find, []
        pieces = self.split(text) if self.split and any(s in text for s in self.special) else (text,)
        for piece in pieces:
            if piece in self.special:
                out.append(struct.pack("<I", self.special[piece]))
            elif piece:
                out += [get(w) or word(w) for w in find(piece)]
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        get = self.bytes.__getitem__
        return b"".join(map(get, memoryview(packed).cast("I").tolist())).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per worker process and file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids (little-endian 32-bit integers as binary) and the decoded text."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def of(text: str, c: Codec) -> tuple[bytes, str]:
        ids = c.encode(text)
        return ids, c.decode(ids)

    return _mapped(docs, path, [key], text, schema, of)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: what encode() gives, hashed where it is made."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def of(text: str, c: Codec) -> tuple[int, str, str]:
        ids = c.encode(text)
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest()

    return _mapped(docs, path, [key], text, schema, of)


def tokens(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns named in keep with n_tokens, ids (binary as in encode()) and decoded_sha256."""
    from pyspark.sql import types as T

    schema = T.StructType([*(docs.schema[k] for k in keep), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded_sha256", T.StringType())])

    def of(text: str, c: Codec) -> tuple[int, bytes, str]:
        ids = c.encode(text)
        return len(ids) // 4, ids, hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest()

    return _mapped(docs, path, keep, text, schema, of)


def _mapped(docs: DataFrame, path: str, keep: list[str], text: str, schema, of) -> DataFrame:
    """The columns in keep, then what of(text, codec) gives, by schema."""
    n = len(keep)
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        c, to = codec(path), to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = list(zip(*(of(t or "", c) for t in part.column(n).to_pylist())))
                yield pa.RecordBatch.from_arrays([*(part.column(i).cast(to.field(i).type) for i in range(n)), *(pa.array(x, to.field(n + i).type) for i, x in enumerate(made))], schema=to)

    return docs.select(*keep, text).mapInArrow(run, schema)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir), vocabulary())
