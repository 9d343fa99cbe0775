"""Lines of .zst files as a data source: splittable at frames, as batch and as stream.

    spark.dataSource.register(ZstLines)
    spark.read.format("zst_lines").load(path)          # column line
    spark.readStream.format("zst_lines").load(path)
    lines.write.format("zst_lines").save(path)

A partition is a byte range and reads the frames that begin in it; a frame is
found by its magic number and proved by walking its block headers to the next
one, so nothing is unpacked to plan a read. A line belongs to the partition in
whose frames its line feed lies; what it takes from frames before is read there
again. Frames are unpacked as a stream: a task holds a piece of a frame and its
longest line, whatever the size of the file. A file of one single frame is one
task's work, that is all its format allows.

A stream's position is the number of bytes of whole frames consumed per file. A
line is emitted when its line feed has arrived; a batch read also gives the last
line of a file that has none. Bytes that are no UTF-8 become replacement
characters instead of failing the task. A frame that is cut off fails a batch
read with its place, and is waited for by a stream.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

# Fixed values of the format: magic numbers of frames and of skippable frames.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
SKIPPABLE_MAGIC = (0x184D2A50, 0x184D2A5F)

SPLIT_BYTES = 32 << 20
FRAME_TEXT = 4 << 20
BATCH_BYTES = 4 << 20
WINDOW = 1 << 20


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def list_files(uri: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the .zst files in a folder, in order of their names."""
    system, path = locate(uri)
    info = system.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [(path, info.size)]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    found = system.get_file_info(pafs.FileSelector(path, recursive=False))
    return sorted((f.path, f.size) for f in found if f.is_file and f.base_name.endswith(".zst") and f.base_name[0] not in "._")


class CutOff(OSError):
    """The file ends inside a frame."""


class Frames:
    """Frame borders of one file, through a window of its bytes."""

    def __init__(self, source: pa.NativeFile, size: int):
        self.source, self.size = source, size
        self.start, self.window = 0, b""

    def bytes_at(self, at: int, count: int) -> bytes:
        if at + count > self.size:
            raise CutOff(f"ends at byte {self.size}, inside a frame")
        if not (self.start <= at and at + count <= self.start + len(self.window)):
            self.source.seek(at)
            self.start, self.window = at, self.source.read(max(WINDOW, count))
        return self.window[at - self.start : at - self.start + count]

    def number(self, at: int, count: int) -> int:
        return int.from_bytes(self.bytes_at(at, count), "little")

    def end(self, at: int) -> int | None:
        """End of the frame that begins at ``at``, None if none does."""
        magic = self.bytes_at(at, 4)
        if SKIPPABLE_MAGIC[0] <= int.from_bytes(magic, "little") <= SKIPPABLE_MAGIC[1]:
            end = at + 8 + self.number(at + 4, 4)
            if end > self.size:
                raise CutOff(f"ends at byte {self.size}, inside a frame")
            return end
        if magic != FRAME_MAGIC:
            return None
        flags = self.number(at + 4, 1)
        if flags & 0b1000:  # reserved
            return None
        single = flags >> 5 & 1
        content = (single, 2, 4, 8)[flags >> 6]
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + content
        last = 0
        while not last:
            header = self.number(at, 3)
            last, kind, size = header & 1, header >> 1 & 3, header >> 3
            if kind == 3 or (kind == 2 and size > 128 << 10):
                return None
            at += 3 + (1 if kind == 1 else size)
        at += 4 * (flags >> 2 & 1)
        if at > self.size:
            raise CutOff(f"ends at byte {self.size}, inside a frame")
        return at

    def _begins(self, at: int) -> bool:
        if at == self.size:
            return True
        if at + 4 > self.size:
            return False
        magic = self.bytes_at(at, 4)
        return magic == FRAME_MAGIC or SKIPPABLE_MAGIC[0] <= int.from_bytes(magic, "little") <= SKIPPABLE_MAGIC[1]

    def first(self, low: int, high: int) -> int | None:
        """First frame that begins in [low, high): its magic, and a chain of blocks that ends where another begins."""
        if low == 0:
            return 0 if self.size else None
        at = low
        while at < high:
            stop = min(at + WINDOW, high + 3, self.size)
            piece = self.bytes_at(at, stop - at)
            found = piece.find(FRAME_MAGIC)
            if found < 0:
                at += max(len(piece) - 3, 1)
                continue
            at += found
            try:
                end = self.end(at)
                if end is not None and self._begins(end):
                    return at
            except CutOff:
                # either the last frame of a file that still grows, or no frame at all
                pass
            at += 1
        return None

    def starting_in(self, low: int, high: int) -> Iterator[tuple[int, int]]:
        """(start, end) of the frames that begin in [low, high)."""
        at = self.first(low, high)
        while at is not None and at < min(high, self.size):
            end = self.end(at)
            if end is None:
                raise OSError(f"no frame at byte {at}")
            yield at, end
            at = end

    def before(self, at: int) -> Iterator[tuple[int, int]]:
        """Frames before ``at``, the nearest first."""
        high = at
        while high > 0:
            low = max(0, high - SPLIT_BYTES)
            frames = list(self.starting_in(low, high))
            yield from reversed(frames)
            high = low if not frames else frames[0][0] if low else 0
            if frames and frames[0][0] == 0:
                return


class _Slice:
    """The bytes [start, end) of a file, as something to read."""

    def __init__(self, source: pa.NativeFile, start: int, end: int):
        self.source, self.at, self.end = source, start, end

    def read(self, count: int = -1) -> bytes:
        left = self.end - self.at
        count = left if count < 0 else min(count, left)
        if not count:
            return b""
        self.source.seek(self.at)
        piece = self.source.read(count)
        self.at += len(piece)
        return piece


def _unpacked(source: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    import zstandard

    # frames may ask for windows beyond the default limit of the decoder
    unpack = zstandard.ZstdDecompressor(max_window_size=1 << 31)
    with unpack.stream_reader(_Slice(source, start, end), read_across_frames=True) as stream:
        while piece := stream.read(1 << 20):
            yield piece


def _unfinished(source: pa.NativeFile, frames: Frames, at: int) -> list[bytes]:
    """Pieces of the line that frames before ``at`` began and did not end."""
    held: list[bytes] = []
    for start, end in frames.before(at):
        tail: list[bytes] = []
        ended = False
        for piece in _unpacked(source, start, end):
            cut = piece.rfind(b"\n")
            if cut >= 0:
                tail, ended = [piece[cut + 1 :]], True
            else:
                tail.append(piece)
        held = tail + held
        if ended:
            break
    return held


def read_range(path: str, uri: str, low: int, high: int, size: int, to_end: bool) -> Iterator[list[bytes]]:
    """Lists of lines whose line feed lies in frames that begin in [low, high) of the first ``size`` bytes.

    ``to_end``: the range is the file's last, and a line without line feed counts too.
    """
    system, _ = locate(uri)
    with system.open_input_file(path) as source:
        frames = Frames(source, size)
        try:
            spans = list(frames.starting_in(low, high))
        except CutOff as error:
            raise CutOff(f"{path} {error}") from None
        if not spans and not (to_end and low == 0):
            if not to_end:
                return
            # frames of an earlier range end the file; its unfinished line is this range's
            rest = b"".join(_unfinished(source, frames, low))
            if rest:
                yield [rest]
            return
        start, end = (spans[0][0], spans[-1][1]) if spans else (0, 0)
        pieces = _unfinished(source, frames, start) if start else []
        held: list[bytes] = []
        count = 0
        for piece in _unpacked(source, start, end):
            lines = piece.split(b"\n")
            if len(lines) == 1:
                pieces.append(piece)
                continue
            held.append(b"".join([*pieces, lines[0]]))
            held.extend(lines[1:-1])
            pieces = [lines[-1]]
            count += len(piece)
            if count >= BATCH_BYTES:
                yield held
                held, count = [], 0
        rest = b"".join(pieces)
        if to_end and end == size and rest:
            held.append(rest)
        if held:
            yield held


@dataclass
class Range(InputPartition):
    path: str
    low: int
    high: int
    size: int
    to_end: bool


def _ranges(path: str, low: int, high: int, size: int, split: int, to_end: bool) -> list[Range]:
    cuts = [*range(low, high, split), high]
    return [Range(path, a, b, size, to_end and b == high) for a, b in zip(cuts, cuts[1:])]


class _Reading:
    def __init__(self, options):
        self.uri = options["path"]
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        for lines in read_range(partition.path, self.uri, partition.low, partition.high, partition.size, partition.to_end):
            text = [line.removesuffix(b"\r").decode("utf-8", "replace") for line in lines]
            yield pa.RecordBatch.from_arrays([pa.array(text, pa.string())], ["line"])


class ZstReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Range]:
        return [r for path, size in list_files(self.uri) for r in _ranges(path, 0, size, size, self.split, True)]


class ZstStreamReader(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Bytes of whole frames in every file."""
        system, _ = locate(self.uri)
        known = getattr(self, "known", {})
        for path, size in list_files(self.uri):
            done = known.get(path, 0)
            if size > done:
                with system.open_input_file(path) as source:
                    frames = Frames(source, size)
                    try:
                        while done < size and (end := frames.end(done)) is not None:
                            done = end
                    except CutOff:
                        pass
            if done:
                known[path] = done
        self.known = known
        return dict(known)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return [r for path in sorted(end) for r in _ranges(path, start.get(path, 0), end[path], end[path], self.split, False)]

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    path: str


class ZstWriter(DataSourceArrowWriter):
    """Part files of several frames; a file appears under its name when all tasks are done."""

    def __init__(self, options, overwrite: bool):
        self.uri, self.overwrite = options["path"], overwrite
        self.frame_text = int(options.get("frameBytes", FRAME_TEXT))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import zstandard

        system, folder = locate(self.uri)
        system.create_dir(folder, recursive=True)
        name = uuid.uuid4().hex
        out = Written(f"{folder}/_{name}", f"{folder}/part-{name}.zst")
        with system.open_output_stream(out.attempt, compression=None) as stream:
            held, size = [], 0

            def flush() -> None:
                # a frame ends with a line
                stream.write(zstandard.ZstdCompressor().compress(b"".join(held)))

            for batch in iterator:
                for value in batch.column(0):
                    line = (value.as_py() or "").encode() + b"\n"
                    held.append(line)
                    size += len(line)
                    if size >= self.frame_text:
                        flush()
                        held, size = [], 0
            if held:
                flush()
        return out

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = locate(self.uri)
        old = [path for path, _ in list_files(self.uri)] if self.overwrite else []
        for message in messages:
            if message is not None:
                system.move(message.attempt, message.path)
        for path in old:
            system.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = locate(self.uri)
        for message in messages:
            if message is not None:
                system.delete_file(message.attempt)


class ZstLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zst_lines"

    def schema(self) -> str:
        return "line string"

    def reader(self, schema) -> ZstReader:
        return ZstReader(self.options)

    def streamReader(self, schema) -> ZstStreamReader:
        return ZstStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> ZstWriter:
        return ZstWriter(self.options, overwrite)
