"""BPE encoding and decoding by a distinct-word table.

1. Tasks split their texts into words as the tokenizer file says (special strings first, then normaliser and pattern) and
   write, per block of documents, each text as numbers into the block's list of distinct words, and that list, cut into parts by
   the words' hash.
2. The lists are exchanged by part.  A part is a piece of the distinct-word table: each of its words is encoded once, in whichever
   blocks it occurs, and the ids go back to the words' places in each block.
3. Blocks and the parts of their lists meet again.  Ids are put together by position; pieces come from a map-side join
   of ids with the id-to-piece table (the vocabulary, of fixed size), once for each word of a block.

``decode`` is the same join for any table of ids.  Lists travel as compressed strings and packed numbers: one row per word and block would take
three times the shuffle space.  A block closes at ``BLOCK_WORDS`` words or ``BLOCK_DISTINCT`` distinct ones, so a task's memory is
bounded, and a word that is everywhere is one entry per block.  Null and empty texts have no ids and decode to the empty text; ids may
be null or repeat; an empty table gives an empty table; other columns travel in a struct, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, start, table, text_or_empty, written
from .tokencount import LETTER, NUMBER, OTHER, SPACE, byte_of_symbol, character_kinds

BLOCK_WORDS, BLOCK_DISTINCT = 4_000_000, 500_000
STRETCH_CHARS = 256  # longer stretches between blanks are split each time


class WordSplitter:
    """Words of a text as the tokenizer file splits them; special strings come out as themselves."""

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = {t["content"] for t in spec["added_tokens"]}
        self.blank_specials = {s for s in self.specials if " " in s or "\n" in s}
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.specials)) + ")") if self.specials else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern).findall
        self.odd = regex.compile(_class_of_differences()).search
        self.byte = {b: s for s, b in byte_of_symbol().items()}
        self.symbol = {s: b for b, s in self.byte.items()}

    def segment(self, text: str) -> list[str]:
        text = self.tokenizer.normalizer.normalize_str(text)
        if self.odd(text):  # characters that this Python's tables class differently: ask the library itself
            return [bytes(self.symbol[c] for c in w).decode() for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return self.words(text)

    def split(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.specials):
            return self.segment(text)
        return [w for part in self.cut.split(text) for w in ([part] if part in self.specials else self.segment(part))]

    def parts(self, text: str) -> list[str]:
        """The text cut at blanks and line feeds: no word, and nothing that the normaliser puts together, crosses them.

        Only these two, since not all that Python takes for white space is so for the tokenizer; a text with a
        special string that holds a blank stays whole."""
        if self.blank_specials and any(s in text for s in self.blank_specials):
            return [text]
        return text.replace("\n", " ").split(" ")

    def encode(self, word: str) -> list[int]:
        if word in self.specials:
            return [self.tokenizer.token_to_id(word)]
        return [t.id for t in self.tokenizer.model.tokenize("".join(self.byte[b] for b in word.encode()))]


def _class_of_differences() -> str:
    """A pattern for the characters whose kind is not the same in the tokenizer library and in ``regex``."""
    import regex

    kinds = np.frombuffer(character_kinds(), np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    own = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        own[np.frombuffer("".join(regex.findall(pattern + "+", every)).encode("utf-32-le"), np.uint32)] = kind
    differ = np.flatnonzero(kinds != own)
    differ = differ[(differ < 0xD800) | (differ >= 0xE000)]
    runs = np.split(differ, np.flatnonzero(np.diff(differ) != 1) + 1) if len(differ) else []
    return "[" + "".join(f"\\U{int(r[0]):08x}-\\U{int(r[-1]):08x}" for r in runs) + "]" if runs else r"(?!)"


_SPLITTERS: dict[str, WordSplitter] = {}


def splitter(path: str) -> WordSplitter:
    if path not in _SPLITTERS:
        _SPLITTERS[path] = WordSplitter(path)
    return _SPLITTERS[path]


# ---------------------------------------------------------------- numbers in few bytes


def pack(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seven bits a byte, high bit on all bytes but a number's last: the bytes, and where each number begins."""
    width = 1 + sum((codes >= (1 << b)).astype(np.int64) for b in (7, 14, 21))
    at = np.concatenate([[0], np.cumsum(width)])
    out = np.zeros(int(at[-1]), np.uint8)
    for k in range(4):
        has = width > k
        more = (width[has] > k + 1).astype(np.uint8) << 7
        out[at[:-1][has] + k] = ((codes[has] >> (7 * k)) & 127).astype(np.uint8) | more
    return out, at


def unpack(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last)
    first = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else np.zeros(0, np.int64)
    shift = 7 * (np.arange(len(data)) - np.repeat(first, ends - first + 1))
    return np.add.reduceat((data & 127).astype(np.int64) << shift, first) if len(first) else np.zeros(0, np.int64)


# ---------------------------------------------------------------- 1. blocks


def _blocks(path: str, parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, packer = splitter(path), zstandard.ZstdCompressor(level=6)  # words hold no line feeds
        block = TaskContext.get().partitionId() << 20
        known: dict[str, int] = {}
        stretches: dict[str, list[int]] = {}  # the words of what stands between blanks, which no word crosses
        rows: list[pa.Array] = []
        codes: list[np.ndarray] = []

        def close() -> Iterator[pa.RecordBatch]:
            whole = np.concatenate(codes) if codes else np.zeros(0, np.int64)
            order = np.argsort(-np.bincount(whole, minlength=len(known)), kind="stable")  # frequent words get short numbers
            rank = np.empty(len(known), np.int64)
            rank[order] = np.arange(len(known))
            schema = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("row", rows[0].type), ("codes", pa.binary()), ("words", pa.binary())])
            data, at = pack(rank[whole])
            ends = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
            cells = [data[at[a] : at[b]].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            n = len(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.concat_arrays(rows), pa.array(cells, pa.binary()), pa.nulls(n, schema.field(4).type)],
                schema=schema)
            words = list(known)
            part = np.array([zlib.crc32(w.encode()) % parts for w in words], np.int32)[order]
            by_part = np.argsort(part, kind="stable")  # numbers ascend inside a part
            for group in np.split(by_part, np.flatnonzero(np.diff(part[by_part])) + 1):
                if len(group):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([part[group[0]]], pa.int32()), pa.nulls(1, rows[0].type),
                         pa.array([pack(np.diff(group, prepend=0))[0].tobytes()], pa.binary()),
                         pa.array([packer.compress("\n".join([words[k] for k in order[group].tolist()]).encode())], pa.binary())], schema=schema)

        size = 0
        for b in batches:
            for run_ in slices(b, limit=1 << 20):
                rows.append(run_.column(0))
                for text in run_.column(1).to_pylist():
                    c: list[int] = []
                    for part in s.parts(text):
                        found = stretches.get(part)
                        if found is None:
                            found = [known.setdefault(w, len(known)) for w in s.split(part)]
                            if len(part) <= STRETCH_CHARS:
                                stretches[part] = found
                        c += found
                    codes.append(np.array(c, np.int64))
                    size += len(c)
                if size >= BLOCK_WORDS or len(known) >= BLOCK_DISTINCT or len(stretches) >= 2 * BLOCK_DISTINCT:
                    yield from close()
                    block, known, stretches, rows, codes, size = block + 1, {}, {}, [], [], 0
        if rows:
            yield from close()

    return run


# ---------------------------------------------------------------- 2. distinct words


def vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The id-to-piece table of a tokenizer file: ``(id, piece)``, as many rows as the vocabulary."""
    return spark.createDataFrame(list(enumerate(pieces_of(path))), "id int, piece string")


def pieces_of(path: str) -> list[str]:
    """The same as a list by id."""
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(path).get_vocab()
    pieces = [""] * (max(ids.values()) + 1)
    for piece, i in ids.items():
        pieces[i] = piece
    return pieces


def decode(ids: DataFrame, vocab: DataFrame, key: str, ids_col: str = "ids") -> DataFrame:
    """``(key, decoded)``: the pieces of each row's ids, joined by spaces.  ``key`` names distinct rows; no ids: the empty text."""
    pieces = ids.select(key, F.posexplode_outer(ids_col).alias("pos", "id")).join(F.broadcast(vocab), "id", "left")
    together = pieces.groupBy(key).agg(F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("pos", "piece")))).alias("p"))
    return together.select(key, F.array_join(F.col("p.piece"), " ").alias("decoded"))


def _encode_parts(path: str, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = splitter(path)
        table: dict[str, np.ndarray] = {}  # this part of the distinct-word table
        packer, opener = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for b in batches:
            for k in range(b.num_rows):
                found = []
                for w in opener.decompress(b.column(2)[k].as_buffer()).decode().split("\n"):
                    ids = table.get(w)
                    if ids is None:
                        ids = table[w] = np.array(s.encode(w), kind)
                    found.append(ids)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(k, 1), b.column(1).slice(k, 1), pa.array([pack(np.array([len(x) for x in found], np.int64))[0].tobytes()], pa.binary()),
                     pa.array([packer.compress(np.concatenate(found).tobytes())], pa.binary())], ["block", "places", "sizes", "ids"])

    return run


# ---------------------------------------------------------------- 3. back by position


def _together(kinds: list[tuple[str, pa.DataType]], finish: Callable, kind: str, shared) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces = shared.value
        fields = pa.schema([left.schema.field("row"), *kinds])
        if not left.num_rows:
            return fields.empty_table()

        def column(name: str, of: Callable) -> np.ndarray:
            return np.concatenate([of(x.as_buffer()) for x in right.column(name)] or [np.zeros(0, np.int64)])

        place = column("places", lambda x: np.cumsum(unpack(np.frombuffer(x, np.uint8))))
        given = column("sizes", lambda x: unpack(np.frombuffer(x, np.uint8)))
        flat = column("ids", lambda x: np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind))
        begin = np.cumsum(given) - given
        size, first = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        size[place], first[place] = given, begin
        text = [" ".join([pieces[i] for i in flat[a : a + n].tolist()]) for a, n in zip(first.tolist(), size.tolist(), strict=True)]
        rows = []
        for cell in left.column("codes"):
            codes = unpack(np.frombuffer(cell.as_buffer(), np.uint8))
            n = size[codes]
            ends = np.cumsum(n)
            at = np.repeat(first[codes] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)
            rows.append(finish(flat[at], " ".join([text[k] for k in codes.tolist()])))
        columns = [pa.array([r[c] for r in rows], fields.field(c + 1).type) for c in range(len(fields) - 1)]
        return pa.Table.from_arrays([left.column("row"), *columns], schema=fields)

    return run


def _whole(ids: np.ndarray, text: str) -> tuple:
    return ids.astype(np.int32), text


def _digest(ids: np.ndarray, text: str) -> tuple:
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def _run(docs: DataFrame, path: str, text_col: str, finish: Callable, kinds: dict[str, tuple[str, pa.DataType]]) -> DataFrame:
    spark = docs.sparkSession
    start(spark)
    others = [c for c in docs.columns if c != text_col] or [F.lit(None).cast("int").alias("none")]
    texts = docs.select(F.struct(*others).alias("row"), text_or_empty(text_col).alias("text"))
    row = texts.schema["row"].dataType
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = f"block long, part int, row {row.simpleString()}, codes binary, words binary"
    blocks = written(texts.mapInArrow(_blocks(path, parts), out), "blocks")
    pieces = pieces_of(path)
    kind = "<u2" if len(pieces) <= 1 << 16 else "<u4"
    listed = blocks.where("part is not null").select("block", F.col("codes").alias("places"), "words", "part").repartition(parts, "part").drop("part")
    encoded = listed.mapInArrow(_encode_parts(path, kind), "block long, places binary, sizes binary, ids binary")
    coded = blocks.where("part is null").select("block", "row", "codes")
    out = f"row {row.simpleString()}, " + ", ".join(f"{n} {t}" for n, (t, _) in kinds.items())
    finished = _together([(n, t) for n, (_, t) in kinds.items()], finish, kind, spark.sparkContext.broadcast(pieces))
    return coded.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(finished, out)


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``(row, ids, decoded)`` for every row; ``row`` is a struct of the row's columns but the text."""
    return _run(docs, path, text_col, _whole, {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string())})


def encode_digests(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``(row, n_tokens, ids_sha256, decoded_sha256)``: the same without the ids and texts themselves."""
    return _run(docs, path, text_col, _digest, {"n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())})


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_digests(docs, public_tokenizers.path("word_bpe_49k.json")).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
