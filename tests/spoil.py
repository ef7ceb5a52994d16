"""Data files that may still be listed and described, but not read."""

import glob
import os
import struct
import zlib


def spoil(path, keep=()):
    """Blank the rows of every Parquet file below ``path`` whose name has none
    of ``keep``; footers stay right. Returns what restores them."""
    before = {}
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        if any(k in f for k in keep) or "/_keys/" in f:
            continue
        with open(f, "rb") as source:
            before[f] = content = source.read()
        footer = int.from_bytes(content[-8:-4], "little") + 8
        _write(f, b"PAR1" + b"\0" * (len(content) - footer - 4) + content[-footer:])
    return before


def _write(f, content):
    """A file and the checksums that the local file system keeps beside it."""
    with open(f, "wb") as out:
        out.write(content)
    beside = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
    if os.path.exists(beside):
        sums = b"".join(struct.pack(">I", zlib.crc32(content[i : i + 512])) for i in range(0, len(content), 512))
        with open(beside, "wb") as out:
            out.write(b"crc\0" + struct.pack(">I", 512) + sums)


def restore(before):
    for f, content in before.items():
        _write(f, content)
