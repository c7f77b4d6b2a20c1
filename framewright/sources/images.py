"""Pictures and captions on a file system: scans, decoding, EXIF dates, writers and packages."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.functions import text
from framewright.operators.filters import distinct_paths

# File endings of pictures, magic bytes, EXIF tags.
ENDINGS = ("jpg", "jpeg", "png", "webp")
MAGIC = {"jpeg": b"\xff\xd8\xff", "png": b"\x89PNG\r\n\x1a\n", "riff": b"RIFF"}
TAG_DATE, TAG_EXIF, TAG_ORIGINAL, TAG_DIGITIZED = 306, 0x8769, 36867, 36868


def picture_glob() -> str:
    return "*.{" + ",".join([*ENDINGS, *map(str.upper, ENDINGS)]) + "}"


def scan(spark: SparkSession, folder: str, contents: bool = False) -> DataFrame:
    """``path``, ``modificationTime``, ``length`` (and ``content``) of the pictures in a folder, not below it, with ``ord``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", picture_glob()).option("recursiveFileLookup", "false").load(folder)
    return distinct_paths(files if contents else files.drop("content"))


def scan_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same files as a stream: each new picture once."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", picture_glob()).load(folder)


def curated(files: DataFrame, trigger: str, fall_back: bool = False) -> DataFrame:
    """Pictures named ``{trigger}_...``; with ``fall_back`` all pictures if none is."""
    name = F.element_at(F.split("path", "/"), -1)
    picture = F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).isin(*ENDINGS)
    ours = picture & F.startswith(name, F.lit(f"{trigger}_"))
    if not fall_back:
        return files.where(ours)
    some = files.agg(F.coalesce(F.bool_or(ours), F.lit(False)).alias("__some"))
    return files.crossJoin(F.broadcast(some)).where(picture & (ours | ~F.col("__some"))).drop("__some")


def captions(spark: SparkSession, folder: str, trigger: str) -> DataFrame:
    """``stem`` and ``text`` of the folder's captions: those of the trigger, or all if there are none."""
    read = lambda glob: spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1).alias("stem"), F.col("value").alias("text"))
    ours = read(f"{trigger}_*.txt")
    return ours if ours.limit(1).count() else read("*.txt")


# ---- bytes -------------------------------------------------------------------------------------


def sizes_of(content: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a JPEG, PNG or WebP file; None if it is none of them or broken off."""
    try:
        if not content:
            return None
        if content.startswith(MAGIC["png"]):
            return struct.unpack(">II", content[16:24])
        if content.startswith(MAGIC["riff"]) and content[8:12] == b"WEBP":
            kind = content[12:16]
            if kind == b"VP8X":
                return 1 + int.from_bytes(content[24:27], "little"), 1 + int.from_bytes(content[27:30], "little")
            if kind == b"VP8L":
                bits = int.from_bytes(content[21:25], "little")
                return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
            if kind == b"VP8 ":
                w, h = struct.unpack("<HH", content[26:30])
                return w & 0x3FFF, h & 0x3FFF
            return None
        if content.startswith(MAGIC["jpeg"]):
            at = 2
            while at + 9 < len(content):
                if content[at] != 0xFF:
                    return None
                marker = content[at + 1]
                if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", content[at + 5 : at + 9])
                    return w, h
                at += 2 + struct.unpack(">H", content[at + 2 : at + 4])[0]
    except (struct.error, IndexError):
        return None
    return None


def exif_date(content: bytes | None) -> str | None:
    """The text of a JPEG's capture date: original, digitised or changed, in this order."""
    try:
        at = (content or b"").find(b"Exif\0\0")
        if at < 0:
            return None
        tiff = content[at + 6 :]
        order = "<" if tiff[:2] == b"II" else ">"

        def entries(start: int) -> dict[int, tuple[int, bytes]]:
            count = struct.unpack(order + "H", tiff[start : start + 2])[0]
            out = {}
            for i in range(count):
                entry = tiff[start + 2 + 12 * i : start + 14 + 12 * i]
                tag, _, n = struct.unpack(order + "HHI", entry[:8])
                out[tag] = (n, entry[8:12])
            return out

        def string(entry: tuple[int, bytes] | None) -> str | None:
            if entry is None:
                return None
            n, value = entry
            raw = value[:n] if n <= 4 else tiff[(p := struct.unpack(order + "I", value)[0]) : p + n]
            return raw.split(b"\0")[0].decode("ascii", "replace") or None

        root = entries(struct.unpack(order + "I", tiff[4:8])[0])
        own = entries(struct.unpack(order + "I", root[TAG_EXIF][1])[0]) if TAG_EXIF in root else {}
        return string(own.get(TAG_ORIGINAL)) or string(own.get(TAG_DIGITIZED)) or string(root.get(TAG_DATE))
    except (struct.error, IndexError):
        return None


def capture_date(exif: Column, modified: Column) -> Column:
    """Date of an EXIF text ``y:m:d ...`` (1970-2100), without its time; else the file's time; else null."""
    first = F.split(F.regexp_replace(F.split(text.strip(exif), r"(?U)\s+")[0], "-", ":"), ":")
    y, m, d = (F.try_element_at(first, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    good = (F.size(first) == 3) & y.between(1970, 2100) & m.between(1, 12) & d.between(1, 31)
    date = F.to_timestamp_ntz(F.format_string("%04d-%02d-%02d", y, m, d), F.lit("yyyy-MM-dd"))
    valid = F.day(F.last_day(F.make_date(F.when(good, y), F.when(good, m), F.lit(1)))) >= d
    return F.coalesce(F.when(good & valid, date), modified.cast("timestamp_ntz"))


def facts(files: DataFrame) -> DataFrame:
    """Scanned files with ``width``, ``height`` (null if unreadable), ``exif`` text, ``captured_at`` and ``year``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = [sizes_of(c) or (None, None) for c in pdf["content"]]
            yield pd.DataFrame({"path": pdf["path"], "modified": pdf["modificationTime"], "width": [w for w, _ in size], "height": [h for _, h in size], "exif": [exif_date(c) for c in pdf["content"]]})

    read = files.select("path", "modificationTime", "content").mapInPandas(run, "path string, modified timestamp, width int, height int, exif string")
    dated = read.withColumn("captured_at", capture_date(F.col("exif"), F.col("modified")))
    return dated.withColumn("year", F.year("captured_at"))


def intact(content: Column) -> Column:
    """Whether the bytes begin and end like a picture: a file that was cut off lacks its end mark or, as RIFF, its length."""
    tail = F.substring(content, -16, 16)
    jpeg = F.startswith(content, F.lit(MAGIC["jpeg"])) & F.contains(F.hex(tail), F.lit("FFD9"))
    png = F.startswith(content, F.lit(MAGIC["png"])) & F.contains(F.hex(tail), F.lit(b"IEND".hex().upper()))
    return jpeg | png | (F.startswith(content, F.lit(MAGIC["riff"])) & (F.length(content) >= _riff_length(content)))


def _riff_length(content: Column) -> Column:
    """Length of the file by its RIFF header, which is little-endian."""
    byte = lambda i: F.conv(F.hex(F.substring(content, i, 1)), 16, 10).cast("long")
    return 8 + byte(5) + byte(6) * 256 + byte(7) * 65_536 + byte(8) * 16_777_216


def dimension_report(files: DataFrame, limit: int = 20) -> DataFrame:
    """``path`` and ``size`` of the first pictures by path; unreadable ones say so."""
    size = F.when(F.col("width").isNull() | F.col("height").isNull(), "Failed to load").otherwise(F.concat(F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string")))
    return files.select("path", size.alias("size")).orderBy("path").limit(limit)


# ---- sinks -------------------------------------------------------------------------------------


def write_captions(rows: DataFrame, folder: str) -> None:
    """One ``{stem}.txt`` per row, UTF-8, written by the executors to a folder they share; overwrites."""

    def write(part: Iterator) -> None:
        import os

        os.makedirs(folder, exist_ok=True)
        for row in part:
            with open(os.path.join(folder, f"{row['stem']}.txt"), "w", encoding="utf-8") as out:
                out.write(row["text"] or "")

    rows.select("stem", "text").foreachPartition(write)


def write_files(rows: DataFrame, folder: str) -> None:
    """One file per row (``out_name``, ``content``), written by the executors to a folder they share; overwrites."""

    def write(part: Iterator) -> None:
        import os

        os.makedirs(folder, exist_ok=True)
        for row in part:
            with open(os.path.join(folder, row["out_name"]), "wb") as out:
                out.write(bytes(row["content"] or b""))

    rows.select("out_name", "content").foreachPartition(write)


def package(pairs: Iterable[tuple[str, bytes, str]], target: str | io.BytesIO) -> int:
    """Zip of (file name, picture, caption) at the archive's root; returns the number of pairs.

    A package is a finished, curated set of at most a few thousand pairs; larger sets stay tables.
    """
    count = 0
    with zipfile.ZipFile(target, "w", compression=zipfile.ZIP_DEFLATED) as out:
        for name, picture, caption in pairs:
            out.writestr(name, picture)
            out.writestr(name.rsplit(".", 1)[0] + ".txt", caption)
            count += 1
    return count
