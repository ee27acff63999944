"""Sum-of-squares online packing of tokenised documents into windows.

A document's ids (its text's, then one end id) fill whole windows first; the
rest is an item of 1 to window - 1 ids.  The level array counts the open
windows at each fill level; an item goes to the level (or a new window) that
leaves the least sum of squared counts, the fuller one on ties.  At the end of
a partition, or when many windows are open, the emptiest windows are poured
into the fullest ones, cutting documents where needed; the one window left is
cut into sequences whose lengths are powers of two, which need no padding.  So
no sequence is padded, and only left-over documents are cut.

Scale: every partition packs its own rows in one pass, without a shuffle;
memory is one document plus the open windows (at most ``OPEN``).  Sequence ids
are numbered within the partition, so a task that is run again gives the same
rows.

Tokenising is most of the cost; see ``Encoder``.
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dosewise.llm.common import arrow_type, id_type
from dosewise.session import ship_package

END_ID = 0
OPEN = 4096        # windows kept open in one task
PIECE = 1 << 20    # characters tokenised at a time
ROWS = 8192        # rows in one output batch

# The byte-level pre-token pattern, and the characters for which
# all regular-expression libraries agree on it.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_OTHER = re.compile("[^\\t\\n\\r -~À-ÖØ-öø-ɏ]")
_SEAM = re.compile(r"(?<=\S)(?= \S)")
_encoders: dict = {}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself if it is visible, else the next one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit bytes.

    A byte-level vocabulary whose merges are in the order of their ids is the
    same thing as a table of ranks, which a faster library reads; it encodes
    texts of ASCII and Latin letters, everything else goes to the tokenizer."""

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, pre = spec["model"].get("vocab", {}), spec.get("pre_tokenizer") or {}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"].get("merges", [])]
        made = [vocab.get("".join(m), -1) for m in merges]
        self.fast = None
        if (spec["model"].get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                and pre.get("use_regex", True) and not spec.get("normalizer") and made == sorted(set(made))):
            byte = byte_alphabet()
            ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        out, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE:
                # a single space between two words starts a pre-token, so a cut there changes no id
                m = _SEAM.search(text, at + PIECE)
                end = m.start() if m else end
            piece = text[at:end]
            if self.fast is None or _OTHER.search(piece) or any(s in piece for s in self.special):
                ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            else:
                ids = self.fast.encode_ordinary(piece)
            out.append(np.array(array("I", ids), "<u4").tobytes())
            at = end
        return b"".join(out)


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Packer:
    """Windows being filled.  A piece is [doc_id, start, ids, doc_tokens]; a
    finished sequence goes to ``emit`` as a list of pieces."""

    def __init__(self, window: int, emit):
        self.window, self.emit = window, emit
        self.count = np.zeros(window + 1, np.int64)   # open windows at each level
        self.at: list[list] = [[] for _ in range(window)]
        self.open = 0

    def add(self, doc_id, ids: bytes) -> None:
        total, size = len(ids) // 4, self.window
        whole = total // size * size
        for start in range(0, whole, size):
            self.emit([[doc_id, start, ids[4 * start:4 * (start + size)], total]])
        if whole < total:
            self.place([doc_id, whole, ids[4 * whole:], total], total - whole)

    def place(self, piece: list, size: int) -> None:
        n, top = self.count, self.window - size
        # change of the sum of squares when a window rises from level h to h + size;
        # a full window leaves the array, and level 0 is a new window
        cost = 2 * n[size:] - 2 * n[:top + 1] + 2
        cost[top] -= 1
        cost[0] -= 1
        cost[1:][n[1:top + 1] == 0] = np.iinfo(np.int64).max
        level = top - int(np.argmin(cost[::-1]))
        if level:
            pieces = self.at[level].pop()
            n[level] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self.emit(pieces)
        else:
            self.at[level + size].append(pieces)
            n[level + size] += 1
            self.open += 1
            if self.open >= OPEN:
                self.pour()

    def pour(self) -> None:
        """Close all open windows."""
        left = [w for level in self.at for w in level]   # emptiest first
        self.at = [[] for _ in range(self.window)]
        self.count[:] = 0
        self.open = 0
        loose: list = []                                 # pieces of the window being emptied
        while left:
            full = left.pop()
            room = self.window - sum(len(p[2]) // 4 for p in full)
            while room and (loose or left):
                if not loose:
                    loose = left.pop(0)[::-1]
                piece = loose.pop()
                n = len(piece[2]) // 4
                if n > room:
                    loose.append([piece[0], piece[1] + room, piece[2][4 * room:], piece[3]])
                    piece, n = [piece[0], piece[1], piece[2][:4 * room], piece[3]], room
                full.append(piece)
                room -= n
            if room == 0:
                self.emit(full)
                if loose and not left:
                    left.append(loose[::-1])
                    loose = []
            else:
                self.powers(full)

    def powers(self, pieces: list) -> None:
        """Cut the last window into sequences of power-of-two lengths."""
        left = pieces[::-1]
        total = sum(len(p[2]) // 4 for p in pieces)
        while total:
            room = 1 << (total.bit_length() - 1)
            total -= room
            out = []
            while room:
                piece = left.pop()
                n = len(piece[2]) // 4
                if n > room:
                    left.append([piece[0], piece[1] + room, piece[2][4 * room:], piece[3]])
                    piece, n = [piece[0], piece[1], piece[2][:4 * room], piece[3]], room
                out.append(piece)
                room -= n
            self.emit(out)


def pack(docs: DataFrame, vocabulary: str, window: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length,
    ids_crc32, doc_tokens (the end id included), sequence_id, offset (in the
    sequence), and ``ids`` (little-endian unsigned 32-bit) if asked for.

    ``vocabulary`` is the path of a tokenizer file that every executor has.  A
    null text is an empty one and gives the end id alone.  Repeated rows are
    packed each; a null doc_id stays null; other columns are not carried.
    """
    kind = id_type(docs)
    fields = [("doc_id", arrow_type(kind))] + [(n, pa.int64()) for n in
              ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    if with_ids:
        fields.append(("ids", pa.binary()))
    schema = pa.schema(fields)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        enc = encoder(vocabulary)
        base = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        done = 0

        def emit(pieces):
            nonlocal done
            offset = 0
            for doc_id, start, ids, total in pieces:
                n = len(ids) // 4
                row = (doc_id, start, n, zlib.crc32(ids), total, base + done, offset)
                rows.append((*row, ids) if with_ids else row)
                offset += n
            done += 1

        def batch():
            out = pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows.clear()
            return out

        packer = Packer(window, emit)
        for b in batches:
            for doc_id, text in zip(b.column(0), b.column(1)):
                text = text.as_py()
                packer.add(doc_id.as_py(), (enc.encode(text) if text else b"") + end)
                if len(rows) >= ROWS:
                    yield batch()
        packer.pour()
        if rows:
            yield batch()

    ship_package(docs.sparkSession)
    out = T.StructType([T.StructField("doc_id", kind)] + [T.StructField(n, T.LongType()) for n, _ in fields[1:7]]
                       + ([T.StructField("ids", T.BinaryType())] if with_ids else []))
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, out)
