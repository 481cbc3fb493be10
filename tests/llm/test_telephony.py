import hashlib
import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from thalweg.llm.telephony import _ADPCM_STEPS, _TAGS, ALAW, MULAW, PIECE, UNIT, code_pcm, codec_of, coded_pcm, decode_adpcm, decode_media, decoded, pad_payload, parse_wav, payload_of, pcm_pieces, store_pcm, store_texts, text_media_features, upsample, wav_bytes


def plain_adpcm(block):
    sample, index = struct.unpack("<hB", block[:3])
    index, out = min(index, 88), [sample]
    for byte in block[4:]:
        for nib in (byte & 15, byte >> 4):
            step = int(_ADPCM_STEPS[index])
            d = step >> 3
            if nib & 4:
                d += step
            if nib & 2:
                d += step >> 1
            if nib & 1:
                d += step >> 2
            sample = max(-32768, min(32767, sample - d if nib & 8 else sample + d))
            index = max(0, min(88, index + (-1, -1, -1, -1, 2, 4, 6, 8)[nib & 7]))
            out.append(sample)
    return out


def plain_feature(payload):
    """The feature of a payload and its samples at 16 kHz, sample by sample."""
    codec = codec_of(payload)
    if codec == "mulaw":
        low = []
        for byte in payload:
            u = ~byte & 255
            size = ((u & 15) * 8 + 132) * 2 ** (u >> 4 & 7) - 132
            low.append(-size if u & 128 else size)
    elif codec == "alaw":
        low = []
        for byte in payload:
            a = byte ^ 0x55
            part, size = a >> 4 & 7, (a & 15) * 16 + 8
            size = size if part == 0 else (size + 256) * 2 ** (part - 1)
            low.append(size if a & 128 else -size)
    else:
        low = [x for k in range(0, len(payload), UNIT) for x in plain_adpcm(b"\0\0\0\0" + payload[k : k + UNIT])]
    high = [v for a, b in zip(low, [*low[1:], low[-1]], strict=True) for v in (a, (a + b) // 2)]
    turns = sum((a < 0) != (b < 0) for a, b in zip(high, high[1:], strict=False))
    crc = zlib.crc32(struct.pack(f"<{len(high)}h", *high))
    return f"{codec};samples={len(high)};peak={max(map(abs, high))};mean={sum(map(abs, high)) // len(high)};turns={turns};crc={crc:08x}", high


@pytest.mark.parametrize("factor", [1, 2, 3])
def test_coded_pcm_gives_every_sample_back(factor):
    r = np.random.default_rng(6)
    steps = np.cumsum(r.choice([-9, 3, 5], 3 * PIECE // 2)).astype(np.int16)
    for x in (r.integers(-32768, 32768, 999).astype(np.int16), np.array([-32768, 32767, -32768], np.int16), steps, np.array([5], np.int16)):
        up = np.concatenate(list(upsample(iter([x]), factor)))
        for samples in (up, x):  # what is no multiple of the factor is kept as it is
            assert np.concatenate(list(coded_pcm(code_pcm(iter([samples[:7], samples[7:7], samples[7:]]), factor)))).tolist() == samples.tolist()
            palette = np.unique(samples)[:256]
            assert np.concatenate(list(coded_pcm(code_pcm(iter([samples]), factor, palette)))).tolist() == samples.tolist()
    assert code_pcm(iter([]), factor) == b""


def test_tables_have_their_known_values():
    assert (MULAW[0], MULAW[0x7F], MULAW[0x80], MULAW[0xFF]) == (-32124, 0, 32124, 0)
    assert (ALAW[0xD5], ALAW[0x55], ALAW[0xAA], ALAW[0x2A]) == (8, -8, 32256, -32256)
    assert len(set(ALAW.tolist())) == 256 and sorted(_TAGS.values()) == [6, 7, 17]


def test_blocks_decode_as_by_the_plain_rule():
    r = random.Random(1)
    raw = [bytes(r.randrange(256) for _ in range(UNIT + 4)) for _ in range(20)] + [b"\xff\x7f\x58\0" + b"\x77" * UNIT, b"\0\x80\xff\0" + b"\xff" * UNIT]
    got = decode_adpcm(np.stack([np.frombuffer(b, np.uint8) for b in raw]))
    assert got.tolist() == [plain_adpcm(b) for b in raw]


def test_upsampling_in_pieces_is_upsampling_at_once():
    x = np.random.default_rng(1).integers(-32768, 32768, 1000).astype(np.int16)
    at_once = np.concatenate(list(upsample(iter([x]), 2)))
    assert np.concatenate(list(upsample(iter([x[:1], x[1:400], x[400:400], x[400:]]), 2))).tolist() == at_once.tolist()
    assert at_once[::2].tolist() == x.tolist() and at_once[1] == (int(x[0]) + int(x[1])) // 2 and len(list(upsample(iter([]), 2))) == 0


def test_files_hold_their_payload():
    for data in (b"", b"a", "é".encode() * 96, bytes(range(256)) * 7):
        payload = pad_payload(data)
        assert len(payload) % UNIT == 0 and payload.startswith(data) and set(payload[len(data) :]) <= {32} and payload
        for codec in _TAGS:
            media = wav_bytes(codec, payload)
            kind, chunk = parse_wav(media)
            assert kind == codec and payload_of(codec, chunk) == payload and struct.unpack_from("<I", media, 4)[0] == len(media) - 8


def test_small_files_together_and_long_ones_in_pieces_decode_alike():
    files = [wav_bytes(c, pad_payload(bytes([k]) * n)) for k, (c, n) in enumerate([("adpcm", 10), ("mulaw", 500), ("adpcm", 700), ("alaw", 0), ("adpcm", 2 * PIECE + 5)])]
    for (codec, data, media, pieces), file in zip(decoded(pa.array(files, pa.binary())), files, strict=True):
        assert media == file
        assert np.concatenate(list(pieces)).tolist() == np.concatenate(list(pcm_pieces(codec, data))).tolist()


def test_texts_come_back(spark):
    texts = [None, "", "abc", "é" * 97, "x" * 1_000_000, "abc"]
    docs = spark.createDataFrame([(i, t, "m") for i, t in enumerate(texts)], "doc_id long, text string, media string")
    got = {r.doc_id: r for r in text_media_features(docs).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload, r = pad_payload(raw), got[i]
        media = wav_bytes(codec_of(payload), payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert (r.media_bytes, r.media_sha256) == (len(media), hashlib.sha256(media).hexdigest())
    assert got[2].feature == got[5].feature and got[0].feature == got[1].feature
    pcm = {r.doc_id: r.pcm for r in decode_media(store_texts(docs)).collect()}
    stored = {r.doc_id: r for r in store_pcm(store_texts(docs)).collect()}
    for i, t in enumerate(texts):
        samples = plain_feature(pad_payload((t or "").encode()))[1] if len(t or "") < 1000 else np.frombuffer(pcm[i], "<i2").tolist()
        assert np.frombuffer(pcm[i], "<i2").tolist() == samples and np.concatenate(list(coded_pcm(stored[i].pcm))).tolist() == samples and stored[i].rate == 16000
        if len(samples) < 10_000:
            assert got[i].feature == plain_feature(pad_payload((t or "").encode()))[0]
    assert text_media_features(docs.limit(0)).count() == 0
