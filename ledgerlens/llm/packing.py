"""Packing by concatenating and cutting.

All documents' tokens, each document closed by an end id, form one stream; the stream is cut
into windows of fixed length. The first pass tokenises, stores the ids with each document's place
in its partition and so knows every partition's total; a prefix sum over these totals gives each
partition its global offset; the second pass joins neighbouring documents and cuts them at the
window borders. Windows that lie within one task's rows are whole at once; the parts of the others,
two for a run of rows or so, meet in a small shuffle. Only the last window can be short; it is
filled with PAD_ID up to ``padded_length``, so padding is below one window over all.

``sequences`` gives the windows: ids as little-endian unsigned 32-bit numbers, how many of them
are tokens, and which piece of which document stands where. ``pack`` takes the pieces out of them
again, each with the CRC of its ids as they stand in the sequence.

Defined results: a null text is empty and gives the end id alone; rows that repeat are packed
once each; an empty table gives no sequence and no piece. The order of the stream is that of the
input partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

WINDOW = 4096
END_ID = 2
#: Fills the last sequence; ``length`` says where the tokens end.
PAD_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Distinct words in the newer half of what a task remembers; both halves take about 150 MB at most.
CACHED_WORDS = 400_000
#: What often ends a word of ASCII letters; each is a piece of its own.
MARKS = frozenset(b".,;:!?")
# Fixed value: how the tokenizer file splits texts.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

IDS = "doc_id long, pid long, local_start long, doc_tokens long, ids binary"
BOUNDS = "array<struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>>"
SEQUENCES = f"sequence_id long, length long, ids binary, bounds {BOUNDS}"
PARTS = f"sequence_id long, offset long, ids binary, bounds {BOUNDS}"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Ids of words as bytes; a word that is asked for first is worked out, or taken over from the
    older half of what its encoder remembers."""

    def __init__(self, encoder: WordEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        found = self.encoder.words_before.get(word)
        self[word] = found = self.encoder.word(word) if found is None else found
        return found


class WordEncoder:
    """Ids of texts, word by word where the tokenizer allows it.

    A tokenizer that drops white space and splits by WORD_PATTERN joins nothing across white
    space, so the ids of a text are those of its words in turn, and repeated words are looked up.
    Words of printable Latin-1 are split here and only their pieces go to the model; any other
    word goes through the whole tokenizer. Tokenizers of another build get whole texts.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        import json

        import regex
        from tokenizers import Tokenizer

        self.model, self.cached = Tokenizer.from_file(path), cached
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pieces = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        split = pieces[0].get("pattern") == {"Regex": WORD_PATTERN} and pieces[0].get("behavior") == "Removed" and pieces[0].get("invert") is True
        bytewise = len(pieces) == 2 and pieces[1].get("type") == "ByteLevel" and not pieces[1].get("add_prefix_space") and not pieces[1].get("use_regex")
        self.by_word = split and bytewise and kinds == ["NFC", "Replace", "Lowercase"] and not spec.get("post_processor")
        self.piece_of, self.plain = regex.compile(WORD_PATTERN), regex.compile(r"[!-~\xa1-\xff]+")
        self.letters = byte_letters()
        self.words = WordIds(self)
        self.words_before: dict[bytes, bytes] = {}  # the older half of what is remembered
        self.pieces: dict[str, bytes] = {}

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each UTF-8 text."""
        import numpy as np

        if not self.by_word:
            return [np.array(x.ids, dtype="<u4").tobytes() for x in self.model.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        out = []
        for text in texts:
            out.append(b"".join(map(self.words.__getitem__, text.split())))
            if len(self.words) > self.cached:
                self.words_before, self.words, self.pieces = self.words, WordIds(self), {}
        return out

    def forget(self) -> None:
        """Let go of the words, so that a worker between tasks holds the model alone."""
        self.words, self.words_before, self.pieces = WordIds(self), {}, {}

    def word(self, word: bytes) -> bytes:
        body, mark = (word[:-1], word[-1:]) if word[-1] in MARKS else (word, b"")
        if body.isalpha():  # ASCII letters alone: one piece
            body, mark = body.lower().decode(), mark.decode()
            return b"".join([self.pieces.get(p) or self.piece(p) for p in (body, mark) if p])
        text = word.decode()
        if b"<|" in word or not self.plain.fullmatch(text):
            return b"".join(i.to_bytes(4, "little") for i in self.model.encode(text, add_special_tokens=False).ids)
        pieces = self.piece_of.findall(text.lower())
        return b"".join([self.pieces.get(p) or self.piece(p) for p in pieces])

    def piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        self.pieces[piece] = ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.model.tokenize(letters)])
        return ids


def byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for
    itself, the others, in order, from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in own)
    return {b: 0x100 + i for i, b in enumerate(others)}


#: Models of this worker process, without words between tasks.
_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str, cached: int = CACHED_WORDS) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    _ENCODERS[path].cached = cached
    return _ENCODERS[path]


def _ids(path: str, end_id: int, cached: int):
    def run(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end, pid, at = encoder(path, cached), end_id.to_bytes(4, "little"), TaskContext.get().partitionId(), 0
        try:
            for batch in batches:
                ids = [x + end for x in encode(shared.text_bytes(batch.column(1)))]
                sizes = [len(x) // 4 for x in ids]
                starts = []
                for n in sizes:
                    starts.append(at)
                    at += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([pid] * len(ids), pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "pid", "local_start", "doc_tokens", "ids"],
                )
        finally:
            encode.forget()
            shared.let_go()

    return run


def _bounds_kind():
    import pyarrow as pa

    return pa.list_(pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "offset")]))


def last_border(place, total, at: int | None, window: int) -> int | None:
    """The last window border that a batch of documents passes, if its rows go on from ``at``
    without a gap."""
    if at is None or not len(place) or place[0] != at or (place[1:] != (place + total)[:-1]).any():
        return None
    border = int(place[-1] + total[-1]) // window * window
    return border if border > at else None


def _cut(window: int, whole: bool):
    """Documents at their places to whole windows, or to the parts of windows that are not whole
    here: where the rows of this task begin, end, or leave out places."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, kinds = ["sequence_id", "offset", "ids", "bounds"], [pa.int64(), pa.int64(), pa.binary(), _bounds_kind()]
        out: list[tuple] = []  # rows to come
        held: list[bytes] = []  # ids of the window that is open, its pieces, its first and next place
        bounds: list[tuple] = []
        first = at = None

        def close() -> None:
            nonlocal held, bounds
            if held and (at - first == window) == whole:
                out.append((first // window, first % window, b"".join(held), bounds))
            held, bounds = [], []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            columns[3] = [[dict(zip(("doc_id", "start", "length", "doc_tokens", "offset"), x, strict=True)) for x in found] for found in columns[3]]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            skip = None
            if not whole and first is not None and first % window == 0:
                # windows from here to the last border are whole: only what lies beyond is looked at
                place, total = batch.column(1).to_numpy(), batch.column(2).to_numpy()
                skip = last_border(place, total, at, window)
                if skip is not None:
                    held, bounds, first, at = [], [], skip, skip
                    batch = batch.filter(pa.array(place + total > skip))
            for doc_id, place, total, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                done = max(0, skip - place) if skip is not None else 0
                if place + done != at:
                    close()
                    first = at = place + done
                while done < total:
                    n = min(total - done, window - at % window)
                    held.append(ids[4 * done : 4 * (done + n)])
                    bounds.append((doc_id, done, n, total, at % window))
                    done, at = done + n, at + n
                    if at % window == 0:
                        close()
                        first = at
            yield rows()
        close()
        yield rows()

    return run


def _joined(window: int):
    """Parts of windows, by sequence and offset, to sequences; the last one is padded."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names, kinds = ["sequence_id", "length", "ids", "bounds"], [pa.int64(), pa.int64(), pa.binary(), _bounds_kind()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for sequence, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = b"".join(p["ids"] for p in parts)
                length = len(ids) // 4
                ids += PAD_ID.to_bytes(4, "little") * (padded_length(length, window) - length)
                for column, value in zip(out, (sequence, length, ids, [x for p in parts for x in p["bounds"]]), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=names)

    return run


def tokenize(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end_id: int = END_ID, cached: int = CACHED_WORDS) -> DataFrame:
    """The first pass, stored: ids of each document and its place within its partition. ``cached``:
    see CACHED_WORDS; fewer take less of a worker and more time."""
    shared.prepare(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return shared.stored(rows.mapInArrow(_ids(path or tokenizer_path(), end_id, cached), IDS), "pack-ids", parts=shared.parts_of(docs))


def offsets(tokens: DataFrame) -> DataFrame:
    """Global start of each partition: a prefix sum over one row for each partition."""
    totals = tokens.groupBy("pid").agg(F.sum("doc_tokens").alias("total"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("pid", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))


def sequences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, path: str | None = None, end_id: int = END_ID, cached: int = CACHED_WORDS) -> DataFrame:
    """One row for each window, with its padded ids and its boundary records; see SEQUENCES."""
    tokens = tokenize(docs, doc_id, text, path, end_id, cached)
    bases = shared.stored(offsets(tokens), "pack-offsets", narrow=True)
    placed = tokens.join(shared.small(bases, bases.count()), "pid").select("doc_id", (F.col("base") + F.col("local_start")).alias("place"), "doc_tokens", "ids")
    whole = placed.mapInArrow(_cut(window, True), PARTS).select("sequence_id", F.lit(window).cast("long").alias("length"), "ids", "bounds")
    parts = placed.mapInArrow(_cut(window, False), PARTS).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "bounds"))).alias("parts"))  # of one window
    return whole.unionByName(parts.mapInArrow(_joined(window), SEQUENCES))


def pieces(packed: DataFrame) -> DataFrame:
    """The boundary records of sequences, a row for each, with the CRC of their ids; see PIECES."""
    crc = lambda b: F.crc32(F.substring(F.col("ids"), (4 * b["offset"] + 1).cast("int"), (4 * b["length"]).cast("int")))
    found = F.transform("bounds", lambda b: F.struct(b.alias("b"), crc(b).alias("ids_crc32")))  # within the row: its ids are not copied for each piece
    return packed.select("sequence_id", F.explode(found).alias("p")).select("p.b.doc_id", "p.b.start", "p.b.length", "p.ids_crc32", "p.b.doc_tokens", "sequence_id", "p.b.offset")


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of a document that lies in one sequence; see PIECES."""
    return pieces(sequences(docs, doc_id, text, window, path, end_id))


def with_pieces(packed: DataFrame) -> DataFrame:
    """Sequences by piece: doc_id, start, length, doc_tokens, sequence_id, offset, and at offset 0,
    once for each sequence, ``sequence_length`` and ``sequence_ids``, its padded ids."""
    head = lambda b, value: F.when(b["offset"] == 0, F.col(value))
    found = F.transform("bounds", lambda b: F.struct(b.alias("b"), head(b, "length").alias("sequence_length"), head(b, "ids").alias("sequence_ids")))
    return packed.select("sequence_id", F.explode(found).alias("p")).select("p.b.doc_id", "p.b.start", "p.b.length", "p.b.doc_tokens", "sequence_id", "p.b.offset", "p.sequence_length", "p.sequence_ids")


def padded_length(length: int, window: int = WINDOW) -> int:
    """What a sequence of so many tokens takes: a power of two stays as it is, others fill up."""
    return length if length > 0 and length & (length - 1) == 0 else window
