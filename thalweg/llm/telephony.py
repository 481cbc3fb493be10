"""Telephony audio in media columns: mu-law, A-law and IMA ADPCM in WAV files, decoded and upsampled to PCM.

Companded codes expand by tables of 256 values. ADPCM is sequential inside a block but blocks are independent, so numpy
steps through the places of a block and does that place in all blocks of a batch at once.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thalweg.llm.bytesops import slices, text_batches
from thalweg.session import shared_path

RATE, TARGET_RATE = 8000, 16000
UNIT = 192
PAD = 32
#: Payload bytes decoded at a time.
PIECE = UNIT << 12
#: Of the media and PCM columns: both are read far more often than written.
ZSTD_LEVEL = 11
CODECS = ("mulaw", "alaw", "adpcm")

# Fixed values of the formats.
_TAGS = {"mulaw": 7, "alaw": 6, "adpcm": 17}
_ADPCM_STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253,
    279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428,
    4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
_ADPCM_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)


def _mulaw_table() -> np.ndarray:
    u = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((u & 15) << 3) + 132) << ((u & 112) >> 4)
    return np.where(u & 128, 132 - size, size - 132).astype(np.int16)


def _alaw_table() -> np.ndarray:
    a = np.arange(256, dtype=np.int32) ^ 0x55
    segment, size = (a & 112) >> 4, (a & 15) << 4
    size = np.where(segment == 0, size + 8, (size + 264) << np.maximum(segment - 1, 0))
    return np.where(a & 128, size, -size).astype(np.int16)


MULAW, ALAW = _mulaw_table(), _alaw_table()
#: The values that companded samples have.
PALETTES = {"mulaw": np.unique(MULAW), "alaw": np.unique(ALAW)}


def _adpcm_tables() -> tuple[np.ndarray, np.ndarray]:
    """By 16 * step index + nibble: the change of the sample and 16 * the next index."""
    nib = np.arange(16)
    step = _ADPCM_STEPS[:, None]
    size = (step >> 3) + (step >> 2) * (nib & 1) + (step >> 1) * (nib >> 1 & 1) + step * (nib >> 2 & 1)
    index = np.clip(np.arange(len(_ADPCM_STEPS))[:, None] + _ADPCM_MOVES[nib & 7], 0, len(_ADPCM_STEPS) - 1)
    return np.where(nib & 8, -size, size).astype(np.int32).ravel(), (index * 16).astype(np.int32).ravel()


_CHANGE, _NEXT = _adpcm_tables()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """Samples of IMA ADPCM mono blocks (rows of header and nibbles): the header's sample, then one a nibble, low nibble first."""
    n, width = blocks.shape
    sample = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], len(_ADPCM_STEPS) - 1).astype(np.int32) * 16
    body = np.ascontiguousarray(blocks[:, 4:].T)
    out = np.empty((1 + 2 * (width - 4), n), np.int16)
    out[0] = sample
    for k in range(width - 4):
        for half in (0, 1):
            at = index + (body[k] >> 4 if half else body[k] & 15)
            sample += _CHANGE[at]
            np.clip(sample, -32768, 32767, out=sample)
            index = _NEXT[at]
            out[1 + 2 * k + half] = sample
    return np.ascontiguousarray(out.T)


def pad_payload(data: bytes) -> bytes:
    """Bytes 32 up to a positive multiple of 192."""
    return data + bytes([PAD]) * (max(UNIT, -(-len(data) // UNIT) * UNIT) - len(data))


def codec_of(payload: bytes) -> str:
    """A codec that depends on the payload alone."""
    return CODECS[zlib.crc32(payload) % len(CODECS)]


def wav_bytes(codec: str, payload: bytes) -> bytes:
    """A WAV file whose samples (or nibbles) are the payload; ADPCM blocks hold 192 bytes behind a header at rest."""
    block, bits, extra, data = 1, 8, b"", payload
    if codec == "adpcm":
        body = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
        data = np.hstack([np.zeros((len(body), 4), np.uint8), body]).tobytes()
        block, bits, extra = UNIT + 4, 4, struct.pack("<H", 2 * UNIT + 1)
    rate = RATE if block == 1 else RATE * block // (2 * UNIT + 1)
    fmt = struct.pack("<HHIIHHH", _TAGS[codec], 1, RATE, rate, block, bits, len(extra)) + extra
    parts = b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + struct.pack("<I", len(data)) + data + b"\0" * (len(data) % 2)
    return b"RIFF" + struct.pack("<I", 4 + len(parts)) + b"WAVE" + parts


def parse_wav(media: bytes) -> tuple[str, memoryview]:
    """The codec and the data chunk of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, codec = 12, None
    while at + 8 <= len(media):
        kind, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if kind == b"fmt ":
            tag = struct.unpack_from("<H", media, at + 8)[0]
            codec = next((c for c, t in _TAGS.items() if t == tag), None)
        elif kind == b"data":
            if codec is None or at + 8 + size > len(media):
                break
            return codec, memoryview(media)[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAV file without a known format or whole data")


def payload_of(codec: str, data: memoryview) -> bytes:
    """The payload of a data chunk that ``wav_bytes`` made."""
    if codec != "adpcm":
        return bytes(data)
    return np.frombuffer(data, np.uint8).reshape(-1, UNIT + 4)[:, 4:].tobytes()


def pcm_pieces(codec: str, data: memoryview) -> Iterator[np.ndarray]:
    """Samples of a data chunk, so many at a time that memory stays bounded for any length."""
    raw = np.frombuffer(data, np.uint8)
    if codec == "adpcm":
        blocks = raw.reshape(-1, UNIT + 4)
        step = PIECE // UNIT
        for at in range(0, len(blocks), step):
            yield decode_adpcm(blocks[at : at + step]).ravel()
    else:
        table = MULAW if codec == "mulaw" else ALAW
        for at in range(0, len(raw), PIECE):
            yield table[raw[at : at + PIECE]]


def decoded(column: pa.Array) -> Iterator[tuple[str, memoryview, bytes, Iterator[np.ndarray]]]:
    """Codec, data chunk, file and pieces of samples of each file; the ADPCM blocks of many small files are decoded at once."""
    sizes = np.fromiter((len(x.as_buffer()) for x in column), np.int64, len(column))
    for i, j in slices(sizes, PIECE):
        files = [x.as_py() for x in column[i:j]]
        parsed = [parse_wav(x) for x in files]
        small = [k for k, (codec, data) in enumerate(parsed) if codec == "adpcm" and len(data) <= PIECE]
        blocks = [np.frombuffer(parsed[k][1], np.uint8).reshape(-1, UNIT + 4) for k in small]
        ready = {}
        if blocks:
            samples = decode_adpcm(np.concatenate(blocks))
            ends = np.cumsum([len(b) for b in blocks])
            ready = {k: samples[e - len(b) : e].ravel() for k, b, e in zip(small, blocks, ends, strict=True)}
        for k, (codec, data) in enumerate(parsed):
            yield codec, data, files[k], iter([ready[k]]) if k in ready else pcm_pieces(codec, data)


def upsample(pieces: Iterator[np.ndarray], factor: int) -> Iterator[np.ndarray]:
    """Linear interpolation by a whole factor, floored; the last sample is held."""

    def between(x: np.ndarray) -> np.ndarray:
        a, b = x[:-1].astype(np.int32), x[1:].astype(np.int32)
        out = np.empty((len(a), factor), np.int16)
        for r in range(factor):
            out[:, r] = (a * (factor - r) + b * r) // factor
        return out.ravel()

    held = None
    for x in pieces:
        if len(x):
            joined = x if held is None else np.concatenate([held, x])
            held = x[-1:]
            yield between(joined)
    if held is not None:
        yield np.repeat(held, factor)


def code_pcm(pieces: Iterator[np.ndarray], factor: int, palette: np.ndarray | None = None) -> bytes:
    """Samples as blocks that compress well and give every sample back.

    A block is its ``factor`` and kind (a byte each), its count of samples, every ``factor``-th sample and, for each place between, what the sample
    there differs by from a straight line, modulo 65536. The samples stand as they are (kind 0), as what each differs by from the one before
    (1), or as places, a byte each, in a sorted palette of at most 256 values in front of them (2).
    """
    out: list[bytes] = []

    def block(x: np.ndarray) -> None:
        own = factor if len(x) % factor == 0 else 1
        grid = x.reshape(-1, own).astype(np.int32)
        base = grid[:, 0]
        between = [(grid[:, r] - _between(base, r, own)).astype("<i2").tobytes() for r in range(1, own)]
        place = np.searchsorted(palette, base) if palette is not None else None
        if place is not None and (palette[np.minimum(place, len(palette) - 1)] == base).all():
            kind, body = 2, struct.pack("<H", len(palette)) + palette.astype("<i2").tobytes() + place.astype(np.uint8).tobytes()
        else:
            steps = np.diff(base, prepend=0)
            kind = int(len(np.unique(steps)) < len(np.unique(base)))
            body = (steps if kind else base).astype("<i2").tobytes()
        out.append(struct.pack("<BBI", own, kind, len(x)) + body + b"".join(between))

    held: list[np.ndarray] = []
    for x in pieces:
        held.append(x)
        if sum(map(len, held)) >= PIECE:
            block(np.concatenate(held))
            held = []
    if held and sum(map(len, held)):
        block(np.concatenate(held))
    return b"".join(out)


def _between(base: np.ndarray, r: int, factor: int) -> np.ndarray:
    """The line's value at the r-th of ``factor`` places behind each sample of a block; behind the last one it is level."""
    return (base * (factor - r) + np.append(base[1:], base[-1:]) * r) // factor


def coded_pcm(data: bytes) -> Iterator[np.ndarray]:
    """The samples of ``code_pcm``, block by block."""
    at = 0
    while at < len(data):
        factor, kind, n = struct.unpack_from("<BBI", data, at)
        at, m = at + 6, n // factor
        if kind == 2:
            size = struct.unpack_from("<H", data, at)[0]
            palette = np.frombuffer(data, "<i2", size, at + 2)
            base = palette[np.frombuffer(data, np.uint8, m, at + 2 + 2 * size)].astype(np.int16)
            at += 2 + 2 * size + m
        else:
            base = np.frombuffer(data, "<i2", m, at)
            # sums modulo 65536, as the differences were
            base = np.cumsum(base, dtype=np.int16) if kind else base.astype(np.int16)
            at += 2 * m
        rows = np.frombuffer(data, "<i2", (factor - 1) * m, at).reshape(factor - 1, m)
        at += 2 * (factor - 1) * m
        grid = np.empty((len(base), factor), np.int16)
        grid[:, 0] = base
        for r in range(1, factor):
            grid[:, r] = (_between(base.astype(np.int32), r, factor) + rows[r - 1]).astype(np.int16)
        yield grid.ravel()


def pcm_feature(pieces: Iterator[np.ndarray]) -> str:
    """Count, peak, mean size, changes of sign and CRC-32 of samples, all whole numbers."""
    count = peak = total = turns = crc = 0
    last = None
    for x in pieces:
        size = np.abs(x.astype(np.int32))
        negative = x < 0
        turns += int(np.count_nonzero(negative[1:] != negative[:-1])) + (last is not None and bool(negative[0]) != last)
        last, count, peak, total, crc = bool(negative[-1]), count + len(x), max(peak, int(size.max())), total + int(size.sum(dtype=np.int64)), zlib.crc32(x.astype("<i2", copy=False).tobytes(), crc)
    return f"samples={count};peak={peak};mean={total // max(1, count)};turns={turns};crc={crc:08x}"


# ---- over tables


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x or b"" for x in batch.column(1).cast(pa.binary()).to_pylist()]
        for i, j in slices(np.fromiter(map(len, texts), np.int64, len(texts)), 4 << 20):
            media, codecs = [], []
            for text in texts[i:j]:
                payload = pad_payload(text)
                codecs.append(codec_of(payload))
                media.append(wav_bytes(codecs[-1], payload))
            sizes = pa.array([len(t) for t in texts[i:j]], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), sizes, pa.array(codecs), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "codec", "media"])


def store_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write each text of ``docs`` (doc_id, text, any more columns) as a WAV file in a column of a table; return the table (doc_id, n_bytes, codec, media)."""
    spark = docs.sparkSession
    text_batches(spark)
    path = path or shared_path(spark, "media")
    schema = "doc_id long, n_bytes long, codec string, media binary"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _written(source.mapInArrow(_store, schema), schema, path)


def _written(rows: DataFrame, schema: str, path: str) -> DataFrame:
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": str(ZSTD_LEVEL), "parquet.page.size": str(8 << 20)}
    rows.write.options(**options).mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def decode_media(table: DataFrame, rate: int = TARGET_RATE) -> DataFrame:
    """Replace ``media`` of (doc_id, codec, media) by ``pcm``: 16-bit little-endian samples at ``rate``, a multiple of 8000. A null stays null."""
    factor = _factor(rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False)).tolist()
            full = batch.column(2).drop_null()
            pcm: list[bytes | None] = [None] * batch.num_rows
            for k, (_, _, _, pieces) in zip(there, decoded(full), strict=True):
                pcm[k] = b"".join(x.tobytes() for x in upsample(pieces, factor))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pcm, pa.binary())], names=["doc_id", "codec", "pcm"])

    return table.select("doc_id", "codec", "media").mapInArrow(run, "doc_id long, codec string, pcm binary")


def _factor(rate: int) -> int:
    if rate <= 0 or rate % RATE:
        raise ValueError(f"the rate must be a multiple of {RATE}")
    return rate // RATE


_PCM = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 binary, tail_crc32 long, media_bytes long, media_sha256 binary, codec string, rate int, pcm binary"


def store_pcm(table: DataFrame, path: str | None = None, rate: int = TARGET_RATE) -> DataFrame:
    """Decode and upsample the files of ``table`` (doc_id, n_bytes, media) and write the samples as a column of a table beside digests of the file and of
    the payload read back from it; return that table. ``coded_pcm`` gives the samples of its column ``pcm``.
    """
    factor = _factor(rate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.binary())
        for batch in batches:
            rows, size, first = [], 0, 0

            def emit(stop: int) -> pa.RecordBatch:
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
                own = [batch.column(c).slice(first, stop - first) for c in (0, 1)]
                return pa.RecordBatch.from_arrays([*own, *columns], names=[x.split()[0] for x in _PCM.split(", ")])

            for k, (codec, data, media, pieces) in enumerate(decoded(batch.column(2)), 1):
                payload = payload_of(codec, data)
                pcm = code_pcm(upsample(pieces, factor), factor, PALETTES.get(codec))
                rows.append((len(payload), hashlib.sha256(payload).digest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).digest(), codec, rate, pcm))
                size += len(pcm)
                if size >= 4 * PIECE:
                    yield emit(k)
                    rows, size, first = [], 0, k
            if rows:
                yield emit(batch.num_rows)

    rows = table.select("doc_id", "n_bytes", "media").mapInArrow(run, _PCM)
    return _written(rows, _PCM, path or shared_path(table.sparkSession, "pcm"))


def pcm_features(table: DataFrame) -> DataFrame:
    """The digests of a table of ``store_pcm`` and a feature of the samples that it holds, a row for each row."""

    @F.arrow_udf("string")
    def feature(codec: pa.Array, pcm: pa.Array) -> pa.Array:
        return pa.array([f"{c};{pcm_feature(coded_pcm(x.as_py()))}" for c, x in zip(codec.to_pylist(), pcm, strict=True)], pa.string())

    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return table.select("doc_id", "n_bytes", "payload_bytes", hexed("payload_sha256"), "tail_crc32", "media_bytes", hexed("media_sha256"), feature("codec", "pcm").alias("feature"))


def text_media_features(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Store every text of ``docs`` as telephony audio, read that back and store it as resampled PCM, and take a feature of this, a row for each row.

    A null or empty text is 192 bytes of padding with n_bytes 0; equal texts have equal values; rows that repeat come back
    each; an empty table gives no rows. The payload is lossless: its bytes are the codes (mu-law, A-law) or nibbles (ADPCM).
    ``path`` is a folder for both tables.
    """
    media = store_texts(docs, path and f"{path}/media")
    return pcm_features(store_pcm(media, path and f"{path}/pcm"))
