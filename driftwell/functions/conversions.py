"""Conversions between encodings, numbers, keys and packed values."""

from __future__ import annotations

import base64
import json
import os
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(v: Column) -> Column:
    """A number from text; null when it is none."""
    return v.try_cast("double")


def integer(v: Column) -> Column:
    return v.try_cast("double").cast("long")


def integers(v: Column) -> Column:
    """Integers from comma-separated text; what is none is left out."""
    return F.array_compact(F.transform(F.split(v, ","), lambda x: F.trim(x).try_cast("long")))


def hex_of(v: Column, digits: int) -> Column:
    return F.lpad(F.hex(v), digits, "0")


def ip_number(v: Column) -> Column:
    p = [F.split_part(v, F.lit("."), F.lit(i)).try_cast("long") for i in range(1, 5)]
    return p[0] * 16777216 + p[1] * 65536 + p[2] * 256 + p[3]


def binary_number(v: Column, bits: int = 64) -> Column:
    """A big-endian binary as a signed integer of so many bits."""
    x = F.conv(F.hex(v), 16, 10).cast("decimal(20,0)")
    half, full = str(2 ** (bits - 1)), str(2**bits)
    return F.when(x >= F.lit(half).cast("decimal(20,0)"), x - F.lit(full).cast("decimal(38,0)")).otherwise(x).cast("long")


def text_hash(v: Column, digits: int = 16) -> Column:
    """A signed integer from the leading hex digits of the text's MD5."""
    return binary_number(F.unhex(F.substring(F.md5(v), 1, digits)), digits * 4)


def structural_hash(*columns: str) -> Column:
    """Equal records hash alike whatever their columns' order; a missing value counts as absent."""
    return F.xxhash64(F.to_json(F.struct(*sorted(columns))))


def as_list(v: Column, is_array: bool) -> Column:
    """A value or an array as an array; missing is empty."""
    return F.coalesce(v, F.array().cast("array<string>")) if is_array else F.when(v.isNull(), F.slice(F.array(v), 1, 0)).otherwise(F.array(v))


def consecutive(v: Column) -> Column:
    """(min, max) pairs of neighbours in comma-separated numbers."""
    a = integers(v)
    n = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(2), n), lambda x, y: F.struct(x.alias("min"), y.alias("max")))


def pack_integers(values: list[int], density: int = 10, least: int = 20) -> dict:
    """Ranges, single terms and exclusions that together say the same as a long list of integers.

    Neighbours closer than the density allows form a range of at least ``least`` values; what a range holds too much is excluded.
    """
    values = sorted(set(values))
    out: dict[str, list] = {"ranges": [], "terms": [], "exclude": []}
    i = 0
    while i < len(values):
        j = i
        while j + 1 < len(values) and (values[j + 1] - values[i] + 1) * (density - 1) <= (j + 2 - i) * density:
            j += 1
        if values[j] - values[i] + 1 >= least:
            out["ranges"].append((values[i], values[j]))
            held = set(values[i : j + 1])
            out["exclude"] += [x for x in range(values[i], values[j] + 1) if x not in held]
        else:
            out["terms"] += values[i : j + 1]
        i = j + 1
    return out


def unpack_integers(c: Column, packed: dict) -> Column:
    test = F.coalesce(c.isin(*packed["terms"]), F.lit(False)) if packed["terms"] else F.lit(False)
    for lo, hi in packed["ranges"]:
        test = test | c.between(lo, hi)
    return test & ~c.isin(*packed["exclude"]) if packed["exclude"] else test


def pipe_encode(v: Any) -> str:
    """Packed text of a value: 0 missing, n number, s text, a array; | and the escape character are escaped."""
    if v is None:
        return "0"
    if isinstance(v, (list, tuple)):
        return "a" + "".join("|" + pipe_encode(x).replace("\\", "\\\\").replace("|", "\\p") for x in v) + "|"
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return f"n{v!r}"
    return "s" + str(v).replace("\\", "\\\\").replace("|", "\\p")


def pipe_decode(text: str) -> Any:
    kind, body = text[:1], text[1:]
    plain = lambda s: s.replace("\\p", "|").replace("\\\\", "\\") if "\\\\" not in s else "\\".join(x.replace("\\p", "|") for x in s.split("\\\\"))
    if kind == "0":
        return None
    if kind == "n":
        return json.loads(body)
    if kind == "s":
        return plain(body)
    if kind == "a":
        return [pipe_decode(plain(x)) for x in body.split("|")[1:-1]]
    raise ValueError(f"not a packed value: {text}")


def encrypt(v: Column, key: bytes) -> Column:
    """AES-256-CBC, as base64 of the initial vector and the cipher text."""
    return F.base64(F.aes_encrypt(v, F.lit(key), F.lit("CBC"), F.lit("PKCS")))


def decrypt(v: Column, key: bytes) -> Column:
    return F.aes_decrypt(F.unbase64(v), F.lit(key), F.lit("CBC"), F.lit("PKCS")).cast("string")


def random_key() -> str:
    return base64.b64encode(os.urandom(32)).decode()
