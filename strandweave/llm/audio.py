"""Media columns: 8-bit PCM sound and its features.

``store_pcm`` packs byte payloads losslessly as 8-bit mono WAV files;
``audio_features`` reads the stored bytes back and computes

* polyphase resampling by a rational factor (windowed-sinc filter, one strided
  matrix product per phase),
* overlapped log-mel filterbanks (Hann window, hop of half a frame),
* hysteresis energy segmentation (a segment opens above the high threshold and
  lasts until the energy falls below the low one),

and cuts the filterbank into tensors of one fixed shape (frames x bands, the
last padded with the floor value), each with its time span.  ``tensor_column``
turns them into Arrow's fixed-shape tensor type.

Everything is per row and depends on nothing but its payload, in bounded blocks
of frames.  Null payloads count as empty; an input column named like an output
column is replaced.
"""

from __future__ import annotations

import struct
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, _parse_datatype_string

from .common import with_arrow

SPANS = "array<struct<start_s:double,stop_s:double>>"
TENSORS = "array<struct<start_s:double,stop_s:double,data:array<float>>>"
RATE, UP, DOWN, FRAME, BANDS, TENSOR_FRAMES = 16000, 1, 2, 256, 20, 64
FLOOR = -10.0
_BLOCK = 4096


def payload(text: Column, multiple: int = 192) -> Column:
    """UTF-8 bytes of a text (null: empty), padded by spaces to a positive multiple."""
    clean = F.coalesce(text, F.lit(""))
    size = F.octet_length(clean)
    return F.concat(clean, F.repeat(F.lit(" "), F.when(size == 0, F.lit(multiple)).otherwise(F.pmod(-size, F.lit(multiple))).cast("int"))).cast("binary")


def wav(samples: bytes, rate: int = RATE) -> bytes:
    """An 8-bit mono WAV file; chunks have even length, so an odd payload gets a pad byte."""
    pad = b"\0" * (len(samples) % 2)
    body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples + pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[int, bytes]:
    """Rate and samples, from the chunks that the file names."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        kind, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if kind == b"fmt ":
            rate = struct.unpack_from("<I", media, at + 12)[0]
        elif kind == b"data":
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


@lru_cache(maxsize=8)
def sinc_filter(up: int, down: int, half: int = 8) -> np.ndarray:
    """Taps by phase (up x taps per phase): a Hann-windowed sinc that cuts at the lower of both Nyquist rates."""
    cut = 1.0 / max(up, down)
    n = 2 * half * max(up, down) + 1
    t = np.arange(n) - n // 2
    taps = cut * np.sinc(cut * t) * np.hanning(n + 2)[1:-1]
    taps *= up / taps.sum()
    width = -(-n // up)
    padded = np.zeros(width * up)
    padded[:n] = taps
    return padded.reshape(width, up).T.copy()


def resample(x: np.ndarray, up: int, down: int) -> np.ndarray:
    """Polyphase resampling by up/down; the filter's delay is taken out and the ends see zeros."""
    if up == down:
        return x.astype(np.float64)
    bank = sinc_filter(up, down)
    width = bank.shape[1]
    delay = (2 * 8 * max(up, down)) // 2
    n = -(-len(x) * up // down)
    padded = np.concatenate([np.zeros(width), x, np.zeros(width + delay // up + 1)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, width)
    out = np.empty(n)
    for r in range(min(up, n)):
        m = np.arange(r, n, up) * down + delay  # position in the upsampled signal
        phase, last = int(m[0] % up), m // up
        rows = last - width + 1 + width
        out[r::up] = np.concatenate([windows[rows[i : i + 65536]] @ bank[phase][::-1] for i in range(0, len(rows), 65536)])
    return out


@lru_cache(maxsize=8)
def mel_bank(frame: int, bands: int, rate: float) -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(0.0), mel(rate / 2), bands + 2) / 2595) - 1)
    f = np.fft.rfftfreq(frame, 1 / rate)
    lo, mid, hi = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.maximum(0, np.minimum((f - lo) / (mid - lo), (hi - f) / (hi - mid))).T.copy()


def log_mel(x: np.ndarray, rate: float, frame: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """log10 band energies (frames x bands) and the energy of each frame; the last frame is padded with zeros."""
    hop = frame // 2
    n = max(1, -(-(len(x) - frame) // hop) + 1)
    x = np.concatenate([x, np.zeros((n - 1) * hop + frame - len(x))]) if (n - 1) * hop + frame > len(x) else x
    frames = np.lib.stride_tricks.sliding_window_view(x, frame)[:: hop][:n]
    window, bank = np.hanning(frame + 2)[1:-1], mel_bank(frame, bands, rate)
    mel, energy = np.empty((n, bands)), np.empty(n)
    for i in range(0, n, _BLOCK):
        part = frames[i : i + _BLOCK] * window
        power = np.abs(np.fft.rfft(part, axis=1)) ** 2
        mel[i : i + _BLOCK] = np.log10(power @ bank + 10.0**FLOOR)
        energy[i : i + _BLOCK] = np.sqrt((part * part).mean(axis=1))
    return mel, energy


def hysteresis(energy: np.ndarray, high: float, low: float) -> list[tuple[int, int]]:
    """Frame spans that open above ``high`` and end before the next frame below ``low``."""
    state = np.where(energy >= high, 1, np.where(energy < low, -1, 0))
    known = np.flatnonzero(state)
    if not len(known):
        return []
    at = np.searchsorted(known, np.arange(len(state)), "right") - 1
    on = (at >= 0) & (state[known[np.maximum(at, 0)]] > 0)
    edge = np.flatnonzero(np.diff(np.r_[0, on.astype(np.int8), 0]))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def features(samples: bytes, rate: int, up: int, down: int, frame: int, bands: int, tensor_frames: int, high: float, low: float) -> tuple[np.ndarray, list, list]:
    x = resample(np.frombuffer(samples, np.uint8).astype(np.float64) / 128 - 1, up, down)
    out_rate = rate * up / down
    hop_s = (frame // 2) / out_rate
    mel, energy = log_mel(x, out_rate, frame, bands)
    mean = energy.mean()
    segments = [(round(a * hop_s, 6), round(b * hop_s, 6)) for a, b in hysteresis(energy, high * mean, low * mean)]
    tensors = []
    for i in range(0, len(mel), tensor_frames):
        block = mel[i : i + tensor_frames]
        full = np.full((tensor_frames, bands), FLOOR, np.float32)
        full[: len(block)] = block
        tensors.append((round(i * hop_s, 6), round((i + len(block)) * hop_s, 6), full.ravel()))
    return mel, segments, tensors


def _store(batch: pa.RecordBatch, column: str, rate: int) -> list:
    return [[wav(x or b"", rate) for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]]


def _features(batch: pa.RecordBatch, column: str, stored: bool, up: int, down: int, frame: int, bands: int, tensor_frames: int, high: float, low: float) -> list:
    read, n_frames, means, segments = [], [], [], []
    spans, data, counts = [], [], []
    for media in batch.column(batch.schema.get_field_index(column)).to_pylist():
        rate, samples = read_wav(media)
        mel, found, tensors = features(samples, rate, up, down, frame, bands, tensor_frames, high, low)
        read.append(samples)
        n_frames.append(len(mel))
        means.append(np.round(mel.mean(axis=0), 2).tolist())
        segments.append([{"start_s": a, "stop_s": b} for a, b in found])
        counts.append(len(tensors))
        spans += [(a, b) for a, b, _ in tensors]
        data += [t for _, _, t in tensors]
    shape = tensor_frames * bands
    flat = pa.array(np.concatenate(data) if data else np.zeros(0, np.float32), pa.float32())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(data) + 1, dtype=np.int32) * shape), flat)
    times = np.array(spans, dtype=np.float64).reshape(-1, 2)
    if stored:
        table = pa.record_batch([pa.array(times[:, 0]), pa.array(times[:, 1]), tensor_column(lists, tensor_frames, bands)], names=["start_s", "stop_s", "data"])
        first = np.r_[0, np.cumsum(counts)].astype(np.int64)
        return [read, n_frames, means, segments, pa.array(counts, pa.int64()), [_stream(table.slice(a, b - a)) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]]
    structs = pa.StructArray.from_arrays([pa.array(times[:, 0]), pa.array(times[:, 1]), lists], names=["start_s", "stop_s", "data"])
    return [read, n_frames, means, segments, pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), structs)]


def _stream(rows: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema) as writer:
        writer.write_batch(rows)
    return out.getvalue().to_pybytes()


def read_tensors(stored: bytes) -> pa.Table:
    """(start_s, stop_s, data) of a stored stream; data is a fixed-shape tensor column."""
    return pa.ipc.open_stream(stored).read_all()


def store_pcm(df: DataFrame, samples: str = "payload", media: str = "media", rate: int = RATE) -> DataFrame:
    """Appends ``media``: the payload as an 8-bit mono WAV file."""
    return with_arrow(df, [StructField(media, BinaryType())], partial(_store, column=samples, rate=rate), samples)


def audio_features(df: DataFrame, media: str = "media", up: int = UP, down: int = DOWN, frame: int = FRAME, bands: int = BANDS, tensor_frames: int = TENSOR_FRAMES, high: float = 1.05, low: float = 0.95, stored: bool = False) -> DataFrame:
    """Appends what the stored sound holds: ``samples`` as read back, ``n_frames``, ``mel_mean`` by band, ``segments``, ``n_tensors`` and ``tensors``.

    Tensors are an array column, or with ``stored`` an Arrow stream of fixed-shape
    tensors with their time spans (``read_tensors``), since Spark has no such type.

    ``high`` and ``low`` are the segmentation thresholds as multiples of the mean energy.
    """
    fields = [StructField("samples", BinaryType()), StructField("n_frames", LongType()), StructField("mel_mean", _parse_datatype_string("array<double>")), StructField("segments", _parse_datatype_string(SPANS)), StructField("n_tensors", LongType()), StructField("tensors", BinaryType() if stored else _parse_datatype_string(TENSORS))]
    return with_arrow(df, fields, partial(_features, column=media, stored=stored, up=up, down=down, frame=frame, bands=bands, tensor_frames=tensor_frames, high=high, low=low), media)


def tensor_column(data: pa.Array, tensor_frames: int = TENSOR_FRAMES, bands: int = BANDS) -> pa.ExtensionArray:
    """A column of flat tensors as Arrow's fixed-shape tensor type."""
    flat = data.combine_chunks() if isinstance(data, pa.ChunkedArray) else data
    storage = flat.cast(pa.list_(pa.float32(), tensor_frames * bands))
    return pa.ExtensionArray.from_storage(pa.fixed_shape_tensor(pa.float32(), [tensor_frames, bands]), storage)
