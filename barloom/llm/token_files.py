"""Token ids in binary files: frequency ranks in byte-aligned variable-length coding.

A file holds blocks of whole documents. Numbers are little-endian:

    4 bytes  BTK1
    u32 x 4  documents, tokens, control bytes, data bytes
    then     keys (i64), key flags (u8, 0: the key is null), tokens per document (u32),
             control bytes, data bytes

Four ranks of a document share a control byte, two bits each, lowest first: bytes of the rank
less one. A document's last control byte may have unused places, which have no data.
"""

import re
import string
from array import array
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.storage import stored
from barloom.llm.texts import Memo, cut, kept
from barloom.sources.workspace import work_folder

MAGIC = b"BTK1"
FILE_TOKENS = 4 << 20
FILE_SAMPLE = 32
BLOCK_TOKENS = 1 << 19
MEMO_WORDS = 400_000
SLICE_BYTES = 8 << 20
#: Bytes of the four ranks of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def _slots(counts: np.ndarray):
    """Which places of the documents' control bytes hold a number, and control bytes per document."""
    quads = -(-counts // 4)
    within = np.arange(4 * quads.sum()) - np.repeat(4 * (np.cumsum(quads) - quads), 4 * quads)
    return within < np.repeat(counts, 4 * quads), quads


def pack(values: np.ndarray, counts: np.ndarray):
    """Control bytes and data bytes of unsigned 32-bit numbers, ``counts`` of them per document, and
    control and data bytes per document."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    data = values.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    held, quads = _slots(counts)
    padded = np.zeros(len(held), np.uint8)
    padded[held] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    upto = np.concatenate(([0], np.cumsum(extra.astype(np.int64) + 1)))
    ends = np.cumsum(counts)
    return control, data, quads, upto[ends] - upto[ends - counts]


def unpack(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers again: lengths by a table of the control bytes, values by gathers."""
    held, _ = _slots(counts)
    sizes = LENGTHS[control].reshape(-1)[held]
    starts = np.cumsum(sizes) - sizes
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    values = padded[starts].astype(np.uint32)
    for byte in range(1, 4):
        some = np.flatnonzero(sizes > byte)
        values[some] |= padded[starts[some] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return values


def block(keys: list, counts: list[int], control: list[bytes], data: list[bytes]) -> bytes:
    """One block of documents that are packed already."""
    control, data = b"".join(control), b"".join(data)
    head = np.array([len(keys), sum(counts), len(control), len(data)], "<u4")
    numbers = np.array([0 if k is None else k for k in keys], "<i8")
    flags = np.array([k is not None for k in keys], np.uint8)
    return b"".join([MAGIC, head.tobytes(), numbers.tobytes(), flags.tobytes(), np.array(counts, "<u4").tobytes(), control, data])


def read_blocks(stream, tokens: np.ndarray):
    """Keys, token counts and ids (one array) of each block of an open file."""
    while mark := stream.read(4):
        if mark != MAGIC:
            raise ValueError("not a token file")
        documents, _, controls, size = np.frombuffer(stream.read(16), "<u4").tolist()
        numbers = np.frombuffer(stream.read(8 * documents), "<i8")
        flags = np.frombuffer(stream.read(documents), np.uint8)
        counts = np.frombuffer(stream.read(4 * documents), "<u4").astype(np.int64)
        control = np.frombuffer(stream.read(controls), np.uint8)
        data = np.frombuffer(stream.read(size), np.uint8)
        yield pa.array(numbers, mask=flags == 0), counts, tokens[unpack(control, data, counts)]


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write bytes with: printable ones as they are, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts from a tokenizer file of the tokenizers library, with an end id after each.

    The tokenizer splits at white space, so each run between ASCII white space is encoded by itself: Latin letters
    by the tokenizer's model, in lower case and apart from ASCII marks that follow them; any other run by the whole
    tokenizer. Equal words and runs of some megabytes of text are found together, by their bytes, and a bounded number
    of them is remembered. Special tokens' strings are ordinary text, or with ``special``
    those tokens, as the library has it by itself.
    """

    #: What the tokenizer's rules surely split in two: Latin letters, and ASCII marks other than an apostrophe. Letters
    #: beyond ASCII are two bytes, C3 and one of those after it. A byte's kinds are bits of one number.
    SPACE, LETTER, CAPITAL, MARK, AFTER_C3, CAPITAL_AFTER_C3, C3 = (1 << k for k in range(7))
    KINDS = sum(np.isin(np.arange(256), list(some)).astype(np.uint8) << np.uint8(k) for k, some in enumerate((
        b" \t\n\v\f\r", string.ascii_letters.encode(), string.ascii_uppercase.encode(), set(string.punctuation.encode()) - set(b"'"),
        set(range(0x80, 0xC0)) - {0x97, 0xB7}, set(range(0x80, 0x9F)) - {0x97}, [0xC3])))
    MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

    def __init__(self, path: str, end: int, memo=MEMO_WORDS, special=False):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = not special
        self.end = np.array([end], "<u4").tobytes()
        self.letters, self.tokenize = _byte_letters(), self.library.model.tokenize
        self.words, self.other = Memo(self._word, memo), Memo(self._other, memo // 8)
        vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.width = np.uint16 if max(end + 1, vocabulary) <= 1 << 16 else np.uint32

    def _word(self, word: bytes) -> bytes:
        """The ids of Latin letters in lower case, by the model alone."""
        spelled = word.decode() if word.isascii() else "".join(map(self.letters.__getitem__, word))
        return array("I", [t.id for t in self.tokenize(spelled)]).tobytes()

    def _other(self, run: bytes) -> bytes:
        return array("I", self.library.encode(run.decode(), add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[bytes | None], limit=SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and their number for each."""
        counts = np.zeros(len(texts), np.int64)
        found, pieces, owners, size = [], [], [], 0
        for i, text in enumerate(texts):
            for piece, last in self._cut(text or b"", limit):
                pieces.append((piece, last))
                owners.append(i)
                size += len(piece) + 1
                if size >= limit:
                    self._add(pieces, owners, counts, found)
                    pieces, owners, size = [], [], 0
        self._add(pieces, owners, counts, found)
        return np.concatenate([np.zeros(0, self.width), *found]), counts

    @staticmethod
    def _cut(text, limit):
        """Parts of about ``limit`` bytes of a longer text, cut where white space is."""
        while len(text) > limit and (space := re.compile(rb"[ \t-\r]").search(text, limit)):
            yield text[:space.start()], False
            text = text[space.end():]
        yield text, True

    def _add(self, pieces, owners, counts, found):
        if not pieces:
            return
        data = b"\n".join(p for p, _ in pieces) + b"\n"
        raw = np.frombuffer(data + bytes(16), np.uint8)
        starts, codes, ids = self._coded(raw, data)
        # Each last piece is followed by the end id, which stands behind the others.
        closed = np.cumsum([len(p) + 1 for p, _ in pieces]) - 1
        before = np.searchsorted(starts, closed)
        last = np.array([last for _, last in pieces])
        order = np.insert(codes, before[last], len(ids))
        ids.append(self.end)
        table = np.frombuffer(b"".join(ids), "<u4").astype(self.width)
        widths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        offsets = np.cumsum(widths) - widths
        taken = widths[order]
        upto = np.cumsum(taken)
        flat = table[np.arange(upto[-1] if len(upto) else 0) + np.repeat(offsets[order] - (upto - taken), taken)]
        found.append(flat)
        sums = np.concatenate(([0], upto))[before + np.cumsum(last)]
        np.add.at(counts, owners, np.diff(sums, prepend=0))

    def _coded(self, raw, data):
        """Where words, marks and other runs start in some text, a code for each, and the ids of each code."""
        kinds = self.KINDS[raw[:len(data)]]
        pairs = (kinds[:-1] & self.C3 != 0) & (kinds[1:] & self.AFTER_C3 != 0)
        letter = kinds & self.LETTER != 0
        letter[:-1] |= pairs
        letter[1:] |= pairs
        space = kinds & self.SPACE != 0
        edges = np.flatnonzero(np.concatenate(([not space[0]], space[1:] != space[:-1])))
        starts, ends = edges[0::2], edges[1::2]
        letters, marks = np.zeros((2, len(data) + 1), np.int32)
        np.cumsum(letter, out=letters[1:])
        np.cumsum(kinds & self.MARK != 0, out=marks[1:])
        count = (letters[ends] - letters[starts]).astype(np.int64)
        plain = (count > 0) & (letters[starts + count] - letters[starts] == count) & (count + marks[ends] - marks[starts] == ends - starts)
        word, marked = np.flatnonzero(plain), plain & (count < ends - starts)
        rest = np.flatnonzero(~plain | marked)
        small = raw.copy()
        capital = kinds & self.CAPITAL != 0
        capital[1:] |= pairs & (kinds[1:] & self.CAPITAL_AFTER_C3 != 0)
        small[:len(data)] += capital.view(np.uint8) << np.uint8(5)
        found, words = self._distinct(small, small.tobytes(), starts[word], count[word])
        beyond = np.where(plain, count, 0)[rest]
        other, runs = self._distinct(raw, data, starts[rest] + beyond, (ends - starts)[rest] - beyond)
        # A word and the marks after it are neighbours in the order of the text.
        at = np.cumsum(1 + marked) - 1
        places, codes = np.empty(len(starts) + marked.sum(), np.int64), np.empty(len(starts) + marked.sum(), np.int64)
        places[at[word] - marked[word]], codes[at[word] - marked[word]] = starts[word], found
        places[at[rest]], codes[at[rest]] = starts[rest] + beyond, other + len(words)
        return places, codes, [*map(self.words.__getitem__, words), *map(self.other.__getitem__, runs)]

    def _distinct(self, raw, data, starts, lengths):
        """A code for each run, and the run of each code: equal bytes, equal code.

        Runs of up to 16 bytes are compared as two numbers each; longer ones, and the few whose
        numbers share a hash with others, one by one.
        """
        wide = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
        low = wide[starts] & self.MASKS[np.minimum(lengths, 8)]
        high = wide[np.minimum(starts + 8, len(wide) - 1)] & self.MASKS[np.clip(lengths - 8, 0, 8)]
        mixed = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= (mixed >> np.uint64(32)) ^ lengths.astype(np.uint64)
        codes = np.full(len(starts), -1, np.int64)
        short = np.flatnonzero(lengths <= 16)
        order = np.argsort(mixed[short])
        fresh = np.diff(mixed[short][order], prepend=np.uint64(0)) != 0
        fresh[:1] = True
        same = np.empty(len(short), np.int64)
        same[order] = np.cumsum(fresh) - 1
        model = short[order[fresh]]
        equal = (low[short] == low[model][same]) & (high[short] == high[model][same]) & (lengths[short] == lengths[model][same])
        codes[short[equal]] = same[equal]
        runs = [data[s:s + n] for s, n in zip(starts[model].tolist(), lengths[model].tolist())]
        others = {}
        for i in np.flatnonzero(codes < 0).tolist():
            run = data[starts[i]:starts[i] + lengths[i]]
            code = others.get(run)
            if code is None:
                code = others[run] = len(runs)
                runs.append(run)
            codes[i] = code
        return codes, runs


def encoder(path: str, end: int, memo=MEMO_WORDS, special=False) -> Encoder:
    """The encoder that the tasks of a worker share, with what it remembers."""
    own = path, end, memo, special
    return kept(own, lambda: Encoder(*own))


def _binary(flat: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive pieces of an array, ``sizes`` bytes each, as binary values."""
    edges = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(np.ascontiguousarray(flat).tobytes())])


def tokenized(df: DataFrame, path: str, end: int, key="doc_id", text="text", memo=MEMO_WORDS, special=False) -> DataFrame:
    """``(key, tie, row, n, ids)``, stored: every text's ids as numbers of two bytes, or four for vocabularies above 65,536.

    ``tie``, a hash of the text, and ``row``, a number of its own, order rows of one key. Texts are encoded once.
    """
    chosen = df.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(F.col(text)).alias("tie"),
                       F.col(text).cast("string").cast("binary").alias("bytes"))

    def run(batches):
        encode, row = encoder(path, end, memo, special), TaskContext.get().partitionId() << 40
        for batch in batches:
            for piece in cut(batch, SLICE_BYTES):
                ids, counts = encode(piece.column(2).to_pylist())
                numbers = pa.array(np.arange(row, row + len(counts)))
                row += len(counts)
                columns = [*piece.columns[:2], numbers, pa.array(counts), _binary(ids, counts * ids.itemsize)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "tie", "row", "n", "ids"])

    return stored(chosen.mapInArrow(run, "key BIGINT, tie BIGINT, row BIGINT, n BIGINT, ids BINARY"), compression="zstd")


def _numbers(column: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The ids of a batch of binary values as one array."""
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    total = int(counts.sum())
    width = (int(edges[-1]) - int(edges[0])) // max(1, total)
    kind = np.dtype("<u4" if width == 4 else "<u2")
    return np.frombuffer(column.buffers()[2], np.uint8)[edges[0]:edges[-1]].view(kind) if total else np.zeros(0, kind)


def frequencies(coded: DataFrame) -> DataFrame:
    """``(id, count)`` over all stored ids; each task counts before anything is shuffled."""
    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            more = np.bincount(_numbers(batch.column(1), batch.column(0).to_numpy()), minlength=len(counts))
            more[:len(counts)] += counts
            counts = more
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "count"])

    return coded.select("n", "ids").mapInArrow(run, "id BIGINT, count BIGINT").groupBy("id").agg(F.sum("count").alias("count"))


def _places(keys, ties, rows) -> np.ndarray:
    """Rows' places in the order of the files, as byte strings that compare alike; rows without a key come first."""
    held = ~keys.is_null().to_numpy(zero_copy_only=False)
    signed = [keys.fill_null(0).to_numpy(), ties.fill_null(0).to_numpy(), rows.to_numpy()]
    parts = [(np.asarray(v, np.int64).view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8) for v in signed]
    return np.ascontiguousarray(np.concatenate([held[:, None].astype(np.uint8), *parts], axis=1)).view("S25").reshape(-1)


def _cuts(coded: DataFrame, total: int, file_tokens: int) -> np.ndarray:
    """Places at which files end, so that each holds about ``file_tokens`` tokens of whole documents.

    A sample of rows, about ``FILE_SAMPLE`` a file, cuts the order into narrow ranges; the tokens of each are summed over
    all rows, and consecutive ranges go to a file while they fit. Rows of one key may be in several files.
    """
    files = -(-total // file_tokens)
    if files < 2:
        return np.zeros(0, "S25")
    order = coded.select("key", "tie", "row", "n")
    rate = min(1.0, FILE_SAMPLE * files / max(1, coded.count()))
    chance = F.pmod(F.xxhash64("key", "row"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = order.where(chance < rate).select("key", "tie", "row").toArrow()
    bounds = np.sort(_places(*(some[c].combine_chunks() for c in ("key", "tie", "row")))) if some.num_rows else np.zeros(0, "S25")
    shared = coded.sparkSession.sparkContext.broadcast(bounds)

    def run(batches):
        sums = np.zeros(len(shared.value) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(shared.value, _places(*batch.columns[:3]), side="left")
            sums += np.bincount(at, batch.column(3).to_numpy(), len(sums)).astype(np.int64)
        seen = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["at", "tokens"])

    summed = order.mapInArrow(run, "at BIGINT, tokens BIGINT").groupBy("at").agg(F.sum("tokens").alias("tokens"))
    tokens = np.zeros(len(bounds) + 1, np.int64)
    for at, n in summed.collect():
        tokens[at] = n
    ends, held = [], 0
    for at, n in enumerate(tokens.tolist()):
        if held and held + n > file_tokens:
            ends.append(bounds[at - 1])
            held = 0
        held += n
    return np.array(ends, "S25")


def write(df: DataFrame, folder: str, path: str, end: int, key="doc_id", text="text",
          file_tokens=FILE_TOKENS, memo=MEMO_WORDS, special=False) -> tuple[DataFrame, list[int]]:
    """Write the ids of all texts to files in ``folder``, in ascending order of the keys.

    Returns the files and the ids by rank. The table of files, ``(part, file, documents, tokens,
    start)``, is stored through Spark after the files: a task that ran twice leaves a file
    that is not in it and that nobody reads. The rank table is as long as the vocabulary in use.
    Keys are whole numbers; other ones stop the job before anything is written. Rows of equal keys go by the hash of
    their text, and may be in several files; null keys come first; null texts are empty. A file holds about
    ``file_tokens`` tokens, or one longer document. ``folder`` has to be one that all executors reach, of a kind that
    Arrow can write to.
    """
    spark = df.sparkSession
    coded = tokenized(df, path, end, key, text, memo, special)
    rows = [tuple(r) for r in frequencies(coded).collect()]
    by_rank = [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    ranks = np.zeros(max(by_rank, default=0) + 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    cuts = _cuts(coded, sum(n for _, n in rows), file_tokens)
    shared = spark.sparkContext.broadcast((ranks, cuts))

    def packed(batches):
        ranks, cuts = shared.value
        for batch in batches:
            for piece in cut(batch, SLICE_BYTES):
                counts = piece.column(3).to_numpy()
                control, data, quads, sizes = pack(ranks[_numbers(piece.column(4), counts)], counts)
                part = np.searchsorted(cuts, _places(*piece.columns[:3]), side="left")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), *piece.columns[:4], _binary(control, quads), _binary(data, sizes)],
                    names=["part", "key", "tie", "row", "n", "control", "data"])

    schema = "part BIGINT, key BIGINT, tie BIGINT, row BIGINT, n BIGINT, control BINARY, data BINARY"
    # A file is a task of its own.
    dealt = coded.mapInArrow(packed, schema).repartitionById(len(cuts) + 1, F.col("part").cast("int"))
    dealt = dealt.sortWithinPartitions("part", "key", "tie", "row").drop("row")

    def run(batches):
        target, inner = fs.FileSystem.from_uri(folder)
        target.create_dir(inner, recursive=True)
        out = part = name = None
        documents = tokens = pending = 0
        held = [], [], [], []

        def closed():
            if held[0]:
                out.write(block(*held))
            out.close()
            columns = [[part], [f"{folder}/{name}"], [documents], [tokens]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["part", "file", "documents", "tokens"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for own, *row in zip(*[columns[i] for i in (0, 1, 3, 4, 5)]):
                if own != part:
                    if out:
                        yield closed()
                    part, documents, tokens, pending, held = own, 0, 0, 0, ([], [], [], [])
                    name = f"{part:08d}-{uuid4().hex}.tok"
                    out = target.open_output_stream(f"{inner}/{name}")
                for column, value in zip(held, row):
                    column.append(value)
                documents, tokens, pending = documents + 1, tokens + row[1], pending + row[1]
                if pending >= BLOCK_TOKENS:
                    out.write(block(*held))
                    held, pending = ([], [], [], []), 0
        if out:
            yield closed()

    files = stored(dealt.mapInArrow(run, "part BIGINT, file STRING, documents BIGINT, tokens BIGINT"))
    # One row per file: few, whatever their total size.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0))), by_rank


def read(files: DataFrame, by_rank: list[int], key="doc_id") -> DataFrame:
    """``(key, start, ids)`` of every document in the files; ``ids`` are little-endian unsigned 32-bit numbers."""
    shared = files.sparkSession.sparkContext.broadcast(np.array(by_rank, "<u4"))
    schema = T.StructType([
        T.StructField(key, T.LongType()), T.StructField("start", T.LongType()), T.StructField("ids", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source, inner = fs.FileSystem.from_uri(file)
                with source.open_input_stream(inner) as stream:
                    for keys, counts, ids in read_blocks(stream, shared.value):
                        ends = np.cumsum(counts)
                        yield pa.RecordBatch.from_arrays(
                            [keys, pa.array(start + ends - counts), _binary(ids, 4 * counts)], names=schema.names)
                        start += int(ends[-1])

    some = files.select("file", "start")
    return some.repartition(max(1, files.count())).mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, end: int, key="doc_id", text="text", **options) -> DataFrame:
    """``read`` of ``write`` in a new shared folder."""
    return read(*write(df, work_folder(df.sparkSession), path, end, key, text, **options), key)
