"""Encoding into pieces of a public tokenizer model, with the bytes each piece came from.

``encode_pieces`` gives for every row the ids, the half-open byte span of each id in the
original UTF-8 text, and the text that the ids decode to. The ids are the library's.

Every text goes through the model's compiled character map by longest prefix, which records for each normalised
byte its place in the original (``charmap.Normalizer``). Pieces lie one after the other in the normalised text, and
their ends there are projected back through that record. A piece that stands for unknown text is as wide as
what the library read, and widths that do not add up to the normalised text are an error.

Null and empty texts have the end id only, with an empty span. Rows are neither dropped
nor joined, so repeated ids give repeated rows. Work is per row: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import charmap
from skyledger.llm.common import ids_and_texts, small_batches

SCHEMA = "id {id}, ids array<int>, starts array<int>, ends array<int>, decoded string"


class PieceCodec:
    """One model: ids and spans of texts, and texts of ids."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        parts = []
        spec = trainer = b""
        for number, value in charmap.proto_fields(model):
            if number == charmap.PIECE_FIELD:
                piece = dict(charmap.proto_fields(value))
                parts.append(piece[1].decode())
            elif number == charmap.NORMALIZER_FIELD:
                spec = value
            elif number == charmap.TRAINER_FIELD:
                trainer = value
        self.normalizer = charmap.Normalizer.from_spec(spec)
        self.unknown = self.library.unk_id()
        asked = dict(charmap.proto_fields(trainer))
        if asked.get(24, 0):
            raise ValueError("models with blanks at the end of words are not supported")
        # Bytes of the normalised text under each piece.
        self.width = np.array([1 if self.library.is_byte(i) else 0 if self.library.is_control(i) else len(p.encode())
                               for i, p in enumerate(parts)], np.int64)

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
        """For each text the ids with the end id, and the starts and ends of their byte spans."""

        end_id = self.library.eos_id()
        for text in texts:
            ids = self.library.encode(text)
            normal, origin = self.normalizer(text.encode())
            width = self.width[np.array(ids, np.int32)]
            if self.unknown in ids:
                surfaces = self.library.encode(text, out_type=str)
                width = np.array([len(s.encode()) if i == self.unknown else w for i, s, w in zip(ids, surfaces, width)], np.int64)
            stops = np.cumsum(width)
            if len(stops) and stops[-1] != len(normal):
                raise ValueError("the pieces are not those of the normalised text")
            yield self._closed(ids, origin[stops - width], origin[stops], end_id)

    @staticmethod
    def _closed(ids, starts, ends, end_id):
        last = ends[-1] if len(ends) else 0
        return [*ids, end_id], np.append(starts, last), np.append(ends, last)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """The codec of a model file, kept by the worker between tasks."""

    with open(path, "rb") as file:
        return PieceCodec(file.read())


def _lists(values: list, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate([np.asarray(v, np.int32) for v in values]) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


def _encoder(path: str, rows: int = 32) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(path)
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                done = list(model.encode(batch.column(1).to_pylist()))
                ids, starts, ends = ([row[k] for row in done] for k in range(3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), _lists(ids, pa.int32()), _lists(starts, pa.int32()), _lists(ends, pa.int32()),
                     pa.array([model.decode(row) for row in ids], pa.string())],
                    names=["id", "ids", "starts", "ends", "decoded"])

    return run


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, starts, ends, decoded) of every text; see the module for the cases."""

    small_batches(docs.sparkSession)
    pairs = ids_and_texts(docs, id_col, text_col)
    return pairs.mapInArrow(_encoder(model_path), SCHEMA.format(id=pairs.schema["id"].dataType.simpleString()))


def piece_digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of encoded texts; ``spans_sha256`` is over all starts, then all ends, as decimals."""

    return encoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.element_at("ends", -1).cast("long").alias("span_bytes"),
        F.sha2(F.concat_ws(" ", F.concat("starts", "ends").cast("array<string>")), 256).alias("spans_sha256"),
    )
