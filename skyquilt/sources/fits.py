"""FITS files without outside help: cards, images, binary tables, and a Spark data source with range reads.

The data source lists (path, ext) rows with headers; pixels are read as windows, by offset into the file, so a task never
holds a tile. On remote paths files come through Spark's own binary reader.
"""

from __future__ import annotations

import io
import os
from collections.abc import Iterator, Mapping, Sequence
from typing import Any, BinaryIO

import numpy as np

BLOCK, CARD = 2880, 80
# BITPIX codes and column formats.
PIXELS = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
FORMATS = {"L": "u1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8"}


def card(key: str, value: Any, comment: str = "") -> str:
    if value is None:
        return f"{key:<8}{comment}"[:CARD].ljust(CARD)
    if isinstance(value, bool):
        text = f"{'T' if value else 'F':>20}"
    elif isinstance(value, (int, np.integer)):
        text = f"{int(value):>20}"
    elif isinstance(value, (float, np.floating)):
        text = f"{float(value)!r:>20}".upper() if np.isfinite(value) else f"'{float(value)}'"
    else:
        text = "'" + str(value).replace("'", "''").ljust(8) + "'"
    return f"{key.upper():<8}= {text}{' / ' + comment if comment else ''}"[:CARD].ljust(CARD)


def header_bytes(cards: Sequence[tuple[str, Any]]) -> bytes:
    text = "".join(card(k, v) for k, v in cards) + "END".ljust(CARD)
    return text.ljust(-(-len(text) // BLOCK) * BLOCK).encode("ascii", "replace")


def parse_value(text: str) -> Any:
    text = text.strip()
    if text.startswith("'"):
        out, i = [], 1
        while i < len(text):
            if text[i] == "'":
                if text[i + 1 : i + 2] != "'":
                    break
                i += 1
            out.append(text[i])
            i += 1
        return "".join(out).rstrip()
    text = text.split("/")[0].strip()
    if text in ("T", "F"):
        return text == "T"
    for kind in (int, float):
        try:
            return kind(text.replace("D", "E"))
        except ValueError:
            pass
    return text or None


def read_header(f: BinaryIO) -> dict[str, Any] | None:
    """The header at the file's position, which moves to its data; None at the end; ValueError for what is no FITS."""
    out: dict[str, Any] = {}
    first = True
    while True:
        block = f.read(BLOCK)
        if first and not block.strip(b"\0 "):
            return None
        if len(block) < BLOCK or first and not block.startswith((b"SIMPLE  =", b"XTENSION=")):
            raise ValueError("not a FITS header")
        first = False
        for i in range(0, BLOCK, CARD):
            line = block[i : i + CARD].decode("ascii", "replace")
            key = line[:8].strip()
            if key == "END":
                return out
            if line[8:10] == "= ":
                out[key] = parse_value(line[10:])


def data_size(h: Mapping[str, Any]) -> int:
    if not h.get("NAXIS"):
        return 0
    n = abs(h["BITPIX"]) // 8 * h.get("GCOUNT", 1)
    axes = [h[f"NAXIS{k + 1}"] for k in range(h["NAXIS"])]
    return n * (int(np.prod(axes)) + h.get("PCOUNT", 0))


def extensions(f: BinaryIO) -> Iterator[tuple[int, str, dict[str, Any], int]]:
    """(index, name, header, offset of the data) of every HDU."""
    index = 0
    while (h := read_header(f)) is not None:
        at = f.tell()
        yield index, str(h.get("EXTNAME") or ("PRIMARY" if index == 0 else f"EXT{index}")), h, at
        f.seek(at + -(-data_size(h) // BLOCK) * BLOCK)
        index += 1


def is_image(h: Mapping[str, Any]) -> bool:
    return h.get("XTENSION", "IMAGE") == "IMAGE" and h.get("NAXIS", 0) == 2


def window(f: BinaryIO, h: Mapping[str, Any], at: int, y0: int, y1: int, x0: int, x1: int) -> np.ndarray:
    """Pixels of rows y0 to y1 - 1 and columns x0 to x1 - 1: only those rows' bytes are read."""
    kind = np.dtype(PIXELS[h["BITPIX"]])
    width = h["NAXIS1"]
    rows = []
    for y in range(y0, y1):
        f.seek(at + (y * width + x0) * kind.itemsize)
        rows.append(np.frombuffer(f.read((x1 - x0) * kind.itemsize), kind))
    out = np.stack(rows) if rows else np.zeros((0, x1 - x0), kind)
    scale, zero = h.get("BSCALE", 1), h.get("BZERO", 0)
    if scale != 1 or zero != 0:
        exact = kind.kind in "iu" and float(scale).is_integer() and float(zero).is_integer()
        return out.astype(np.int64) * int(scale) + int(zero) if exact else out * float(scale) + float(zero)
    return out.astype(kind.newbyteorder("="))


def wcs_of(h: Mapping[str, Any]) -> dict[str, float]:
    """Reference and matrix, from CD, or from CDELT with PC."""
    out = {"crpix1": h.get("CRPIX1", 0.0), "crpix2": h.get("CRPIX2", 0.0), "crval1": h.get("CRVAL1", 0.0), "crval2": h.get("CRVAL2", 0.0)}
    step = {1: h.get("CDELT1", 1.0), 2: h.get("CDELT2", 1.0)}
    for i in (1, 2):
        for j in (1, 2):
            if any(f"CD{a}_{b}" in h for a in (1, 2) for b in (1, 2)):
                out[f"cd{i}{j}"] = h.get(f"CD{i}_{j}", 0.0)
            else:
                out[f"cd{i}{j}"] = step[i] * h.get(f"PC{i}_{j}", float(i == j))
    return {k: float(v) for k, v in out.items()}


def wcs_cards(wcs: Mapping[str, float]) -> list[tuple[str, Any]]:
    return [("WCSAXES", 2), ("CTYPE1", "RA---TAN"), ("CTYPE2", "DEC--TAN"), ("CUNIT1", "deg"), ("CUNIT2", "deg"), *((f"{k.upper()[:-1]}{k[-1]}", wcs[k]) for k in ("crpix1", "crpix2", "crval1", "crval2")), *((f"CD{k[2]}_{k[3]}", wcs[k]) for k in ("cd11", "cd12", "cd21", "cd22"))]


def image_hdu(data: np.ndarray | None, cards: Sequence[tuple[str, Any]] = (), primary: bool = False) -> bytes:
    """One image with its header; unsigned 16-bit values get BZERO."""
    head: list[tuple[str, Any]] = [("SIMPLE", True)] if primary else [("XTENSION", "IMAGE")]
    body, more = b"", []
    if data is None:
        head += [("BITPIX", 8), ("NAXIS", 0)]
    else:
        if data.dtype == np.uint16:
            data, more = (data.astype(np.int32) - 32768).astype(np.int16), [("BZERO", 32768), ("BSCALE", 1)]
        code = next(k for k, v in PIXELS.items() if np.dtype(v) == data.dtype.newbyteorder(">"))
        head += [("BITPIX", code), ("NAXIS", data.ndim), *((f"NAXIS{k + 1}", n) for k, n in enumerate(reversed(data.shape)))]
        body = data.astype(PIXELS[code]).tobytes()
        body += b"\0" * (-len(body) % BLOCK)
    head += [("EXTEND", True)] if primary else [("PCOUNT", 0), ("GCOUNT", 1)]
    return header_bytes([*head, *more, *cards]) + body


def table_hdu(columns: Mapping[str, Sequence[Any]]) -> bytes:
    """A binary table of integer, float and text columns."""
    parts, cards = [], []
    for k, (name, values) in enumerate(columns.items(), 1):
        v = np.asarray(values)
        if v.dtype.kind in "US":
            v = np.char.encode(v.astype(str), "ascii")
            form = f"{max(1, v.dtype.itemsize)}A"
            v = v.astype(f"S{max(1, v.dtype.itemsize)}")
        else:
            form = {"i": "K", "u": "K", "f": "D", "b": "L"}[v.dtype.kind]
            v = np.where(v, ord("T"), ord("F")).astype("u1") if form == "L" else v.astype(FORMATS[form])
        parts.append((name, v))
        cards += [(f"TTYPE{k}", name), (f"TFORM{k}", form if form[-1] == "A" else f"1{form}")]
    rows = np.zeros(len(parts[0][1]) if parts else 0, [(n, v.dtype) for n, v in parts])
    for n, v in parts:
        rows[n] = v
    head = [("XTENSION", "BINTABLE"), ("BITPIX", 8), ("NAXIS", 2), ("NAXIS1", rows.dtype.itemsize), ("NAXIS2", len(rows)), ("PCOUNT", 0), ("GCOUNT", 1), ("TFIELDS", len(parts)), *cards]
    body = rows.tobytes()
    return header_bytes(head) + body + b"\0" * (-len(body) % BLOCK)


def table_type(h: Mapping[str, Any]) -> np.dtype:
    fields = []
    for k in range(1, h["TFIELDS"] + 1):
        form = str(h[f"TFORM{k}"]).strip()
        count = int(form[:-1] or 1)
        fields.append((str(h[f"TTYPE{k}"]), f"S{count}") if form[-1] == "A" else (str(h[f"TTYPE{k}"]), FORMATS[form[-1]]) if count == 1 else (str(h[f"TTYPE{k}"]), FORMATS[form[-1]], (count,)))
    return np.dtype(fields)


def table_rows(f: BinaryIO, h: Mapping[str, Any], at: int, first: int, last: int) -> dict[str, list]:
    """Columns of rows first to last - 1 of a binary table."""
    kind = table_type(h)
    f.seek(at + first * kind.itemsize)
    rows = np.frombuffer(f.read((last - first) * kind.itemsize), kind)
    out = {}
    for k, name in enumerate(kind.names, 1):
        v = rows[name]
        if v.dtype.kind == "S":
            out[name] = [x.decode("ascii", "replace").rstrip() for x in v.tolist()]
        elif str(h[f"TFORM{k}"]).strip().endswith("L"):
            out[name] = (v == ord("T")).tolist()
        else:
            out[name] = v.tolist()
    return out


def inspect(path: str) -> dict[str, Any]:
    """HDUs of a file with index, name, type and whether they hold data; problems stand in `error`."""
    out: dict[str, Any] = {"path": path, "num_extensions": 0, "extensions": [], "error": None}
    try:
        with open(path, "rb") as f:
            for index, name, h, _ in extensions(f):
                kind = "PrimaryHDU" if index == 0 else {"IMAGE": "ImageHDU", "BINTABLE": "BinTableHDU"}.get(h.get("XTENSION"), "HDU")
                out["extensions"].append({"index": index, "name": name, "type": kind, "has_data": data_size(h) > 0})
        out["num_extensions"] = len(out["extensions"])
    except (OSError, ValueError, KeyError) as e:
        out["error"] = str(e)
    return out


def opened(path: str) -> BinaryIO:
    local = path.removeprefix("file://").removeprefix("file:")
    if not os.path.exists(local):
        raise FileNotFoundError(local)
    return open(local, "rb")


def from_bytes(content: bytes) -> BinaryIO:
    return io.BytesIO(content)
