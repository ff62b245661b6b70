"""Operator 9, SentencePiece encoding and decoding: a merge-type prefix table.

BPE gives every prefix of a text one encoding, so one token id for each prefix -- its last
token -- is enough to hold the encodings of all prefixes.  The table is filled from left to
right: an Aho-Corasick automaton lists the pieces that end at a position, the longest first,
and the piece is the last token there if it can stand after the last token of the prefix
before it, that is, if merging the two pieces' characters gives back exactly these two.  Each
pair is tested once and remembered (at most vocabulary squared entries, in practice a few
hundred thousand).  The ids are then read backwards, from the end of the table.

No piece holds a space mark after another character, nor a character outside the pieces (such
as a newline here), so no merge crosses these places: a text is cut there, and the ids of
recent chunks are kept in a bounded table.  The whole text is encoded, whatever its length.

Defined results: a null text is encoded as the empty one; empty text gives only the end id;
characters that no piece has become their UTF-8 bytes; repeated rows give repeated results;
other columns of the input are kept by :func:`encode` (``ids_col`` replaces one of that name).
"""

from __future__ import annotations

import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import claim, ready, table

SPACE = "▁"
#: The model file is sent to the workers whole; a larger one is refused.
MAX_MODEL_BYTES = 16 << 20
#: Chunks and pairs that a worker remembers; beyond it the chunks of the last
#: period are dropped (two periods are held), and the pairs start anew.
MAX_CHUNKS = 450_000
MAX_PAIRS = 1_000_000
#: Chunks longer than this are not remembered.
MAX_CHUNK_CHARS = 64


class Pieces:
    """Encoder and decoder of one SentencePiece BPE model (byte fallback, identity
    normalisation, a space mark put first)."""

    def __init__(self, proto: bytes, remembered: int = MAX_CHUNKS):
        import sentencepiece

        self.max_chunks, self.max_pairs = remembered, min(MAX_PAIRS, 2 * remembered)

        m = sentencepiece.SentencePieceProcessor(model_proto=proto)
        n = m.get_piece_size()
        special = [m.is_control(i) or m.is_unknown(i) or m.is_unused(i) for i in range(n)]
        byte = [m.is_byte(i) for i in range(n)]
        names = [m.id_to_piece(i) for i in range(n)]
        self.end = m.eos_id()
        self.score = {names[i]: m.get_score(i) for i in range(n) if not special[i] and not byte[i]}
        self.id = {names[i]: i for i in range(n) if not special[i] and not byte[i]}
        self.name = names
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if byte[i]}
        self.raw = np.empty(n, dtype=object)
        for i in range(n):
            self.raw[i] = (b"" if special[i] else bytes([int(names[i][3:5], 16)]) if byte[i]
                           else names[i].replace(SPACE, " ").encode())
        if len(self.byte_id) != 256 or m.encode("a  b", out_type=str)[0][0] != SPACE:
            raise ValueError("only BPE models with byte fallback and a leading space mark")
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        inner = any(SPACE in p.lstrip(SPACE) for p in self.id)
        cut = "".join(c for c in "\n\r\t" if not any(c in p for p in self.id))
        self.split = re.compile(r"(?s).+" if inner else f"{SPACE}+[^{SPACE}{cut}]*|[^{SPACE}{cut}]+" +
                                (f"|[{cut}]+" if cut else "")).findall
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """The characters of a short text, merged best score first, leftmost first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether ``right`` can stand after ``left`` (negative: nothing before it)."""
        if left < 0:
            ok = len(self.merged(self.name[right])) == 1
        else:
            a, b = self.name[left], self.name[right]
            ok = self.merged(a + b) == [a, b]
        if len(self.pairs) >= self.max_pairs:
            self.pairs.clear()
        self.pairs[(left << 20) + right] = ok
        return ok

    def chunk(self, text: str) -> bytes:
        """The chunk's ids as 32-bit integers."""
        last, known = [-1] * len(text), self.pairs.get
        for end, (piece, size) in self.automaton.iter(text):
            if last[end] < 0:
                before = last[end - size] if end >= size else -1
                ok = known((before << 20) + piece)
                if ok or ok is None and self.fits(before, piece):
                    last[end] = piece
        out, at, name = [], len(text) - 1, self.name
        while at >= 0:
            piece = last[at]
            if piece >= 0:
                out.append(piece)
                at -= len(name[piece])
            else:
                out += [self.byte_id[b] for b in reversed(text[at].encode())]
                at -= 1
        return array("i", out[::-1]).tobytes()

    def ids(self, text: str) -> bytes:
        """The text's ids, without an end id, as 32-bit integers."""
        if not text:
            return b""
        new, out = self.chunks, []
        for c in self.split(SPACE + text.replace(" ", SPACE)):
            ids = new.get(c)
            if ids is None:
                ids = self.older.get(c)
                if ids is None:
                    ids = self.chunk(c)
                if len(c) <= MAX_CHUNK_CHARS:
                    if len(new) >= self.max_chunks:
                        self.older, self.chunks = new, {}
                        new = self.chunks
                    new[c] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(self.raw[ids].tolist()).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


_LOADED: dict[int, Pieces] = {}


def _by_proto(sent: tuple[bytes, int]) -> Pieces:
    claim("pieces", _LOADED.clear)
    key = hash(sent)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Pieces(*sent)
    return _LOADED[key]


def _encoder(bc):
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        model = _by_proto(bc.value)
        end = array("i", [model.end]).tobytes()
        parts = [model.ids(t or "") + end for t in texts.to_pylist()]
        offsets = np.zeros(len(parts) + 1, dtype=np.int32)
        np.cumsum([len(p) // 4 for p in parts], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), np.int32), pa.int32()))

    return encode


def _decoder(bc):
    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        model = _by_proto(bc.value)
        flat, at = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        return pa.array([None if null[i] else model.decode(flat[at[i]:at[i + 1]]) for i in range(len(ids))], pa.string())

    return decode


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:  # the tokenizer's file, installed beside the driver
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError(f"{path} has more than {MAX_MODEL_BYTES} bytes")
    return data


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", remembered: int = MAX_CHUNKS) -> DataFrame:
    """``docs`` with ``ids_col``: the text's ids and the end id.  ``remembered`` bounds what a worker keeps (chunks; about
    250 bytes each, two periods)."""
    spark = docs.sparkSession
    ready(spark)
    bc = spark.sparkContext.broadcast((model_bytes(model_path), remembered))
    return docs.withColumn(ids_col, _encoder(bc)(F.col(text_col)))


def decode(docs: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded", remembered: int = MAX_CHUNKS) -> DataFrame:
    """``docs`` with ``out_col``: the text of the ids (control ids have none)."""
    spark = docs.sparkSession
    ready(spark)
    bc = spark.sparkContext.broadcast((model_bytes(model_path), remembered))
    return docs.withColumn(out_col, _decoder(bc)(F.col(ids_col)))


def digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row."""
    path = model_path or default_model()
    d = decode(encode(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), path), path)
    return d.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256"))


def op9(spark, sf_dir) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
