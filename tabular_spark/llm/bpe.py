"""Byte-level BPE with forced-boundary splitting.

A pair of bytes that stands inside no token of the vocabulary can be bridged by no merge, so a
text may be cut there. Cuts are also kept where the splitting pattern of the vocabulary could see
over them: none after white space (runs of it are split by what follows), and none before an
apostrophe (it may open a contraction). The fragments, mostly single words, are encoded
independently, each distinct one once per task as long as it is remembered, and concatenated.

Cases: a null text counts as empty and has no tokens; text of any length is cut as it is;
special strings of the tokenizer that stand in a text become their token, as the library does it;
repeated rows stay; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabular_spark.llm.common import text_of

#: Fragments remembered by a task, and the longest one that is worth it. What isn't remembered is encoded anew.
REMEMBERED, LONGEST = 300_000, 48
#: Text bytes that are taken apart at once.
CHUNK = 2 << 20


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryCodec:
    """Encodes and decodes with one tokenizer file."""

    def __init__(self, path: str | None = None):
        import json
        import os

        import numpy as np

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        self.bytes_of = {i: bytes(alphabet[c] for c in token) for token, i in spec["model"]["vocab"].items()}
        self.bytes_of |= {x["id"]: x["content"].encode() for x in spec["added_tokens"]}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.forced = np.ones(65536, bool)
        for token in self.bytes_of.values():
            for a, b in zip(token, token[1:]):
                self.forced[a << 8 | b] = False
        left, right = np.indices((256, 256))
        inside = (right & 0xC0) == 0x80  # a cut falls between characters
        self.forced &= ~(inside | (left <= 32) | (left == 127) | (right == ord("'"))).reshape(-1)
        #: Last but one bytes of the white space beyond ASCII (and of some other characters, which costs cuts only).
        self.maybe_space = np.isin(np.arange(256), [0x80, 0x81, 0x9A, 0xA0, 0xC2])
        self.ids: dict[bytes, bytes] = {}
        self.decoded: dict[bytes, bytes] = {}

    def fragments(self, text: bytes) -> list[bytes]:
        import numpy as np

        raw = np.frombuffer(text, np.uint8)
        if len(raw) < 2:
            return [text] if text else []
        cut = self.forced[raw[:-1].astype(np.uint16) << 8 | raw[1:]]
        beyond = raw[:-1] >= 128
        cut[1:] &= ~(beyond[1:] & self.maybe_space[raw[:-2]])
        at = [0, *(np.flatnonzero(cut) + 1).tolist(), len(raw)]
        return [text[a:b] for a, b in zip(at, at[1:])]

    def learn(self, fragments: Iterable[bytes]) -> tuple[dict[bytes, bytes], dict[bytes, bytes]]:
        """Ids (packed as int32) and decoded bytes of fragments that aren't remembered."""
        import numpy as np

        new = list(fragments)
        ids, decoded = {}, {}
        for fragment, found in zip(new, self.tokenizer.encode_batch([x.decode() for x in new], add_special_tokens=False)):
            ids[fragment] = np.array(found.ids, np.int32).tobytes()
            decoded[fragment] = b"".join(self.bytes_of[i] for i in found.ids)
        return ids, decoded

    def encode_decode(self, texts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its packed ids and the bytes that these stand for."""
        parts = [self.fragments(x) for x in texts]
        new = {f for p in parts for f in p if f not in self.ids}
        ids, decoded = self.learn(new)
        if len(self.ids) + len(ids) > REMEMBERED:
            self.ids, self.decoded = {}, {}
            again = {f for p in parts for f in p} - new
            more = self.learn(again)
            ids |= more[0]
            decoded |= more[1]
        short = [f for f in ids if len(f) <= LONGEST]
        self.ids.update((f, ids[f]) for f in short)
        self.decoded.update((f, decoded[f]) for f in short)
        for p in parts:
            yield b"".join([self.ids.get(f) or ids[f] for f in p]), b"".join([self.decoded.get(f) or decoded[f] for f in p])


def chunks(column, most: int = CHUNK) -> Iterator[list[bytes]]:
    """The texts of an Arrow column as UTF-8, in runs of about ``most`` bytes."""
    run, size = [], 0
    for value in column:
        run.append(text := (value.as_py() or "").encode())
        size += len(text)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer_path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of every document; ``tokenizer_path`` is a file that executors can read (default: the public 50k vocabulary)."""
    slim = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        codec = ForcedBoundaryCodec(tokenizer_path)
        for batch in batches:
            done = 0
            for texts in chunks(batch.column(1)):
                packed, decoded = zip(*codec.encode_decode(texts))
                ends = np.cumsum([0, *(len(x) // 4 for x in packed)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), np.int32)))
                words = pa.array([x.decode("utf-8", "replace") for x in decoded], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(texts)), ids, words], ["doc_id", "ids", "decoded"])
                done += len(texts)

    return slim.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def op5(docs: DataFrame) -> DataFrame:
    return encode_decode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )
