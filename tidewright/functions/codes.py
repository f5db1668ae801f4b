"""Stock codes, sector names and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters trimmed from codes, and full-width letters and digits with their ASCII forms.
TRIMMED = "\t\n\x0b\x0c\r   " + "".join(map(chr, range(0x2000, 0x200B))) + "    　﻿"
_WIDE = "".join(chr(c + 0xFEE0) for c in [*range(48, 58), *range(65, 91), *range(97, 123)])
_ASCII = "".join(chr(c) for c in [*range(48, 58), *range(65, 91), *range(97, 123)])


def to_ascii(c: Column) -> Column:
    return F.translate(c, _WIDE, _ASCII)


def normalize_stock_code(c: Column) -> Column:
    """Trimmed, in ASCII and upper case; null gives the empty text."""
    return F.upper(to_ascii(F.regexp_replace(F.coalesce(c, F.lit("")), f"^[{TRIMMED}]+|[{TRIMMED}]+$", "")))


def parse_stock_code(c: Column) -> Column:
    code = normalize_stock_code(c)
    return F.when(code.rlike("^[0-9]{3}[0-9A-Z]$"), code)


def source_code_to_ticker(c: Column) -> Column:
    """Four characters as they are, five that end in 0 without it; otherwise null."""
    code = normalize_stock_code(c)
    return F.when(code.rlike("^[0-9]{3}[0-9A-Z]0?$"), F.substring(code, 1, 4))


def margin_code_to_key(c: Column) -> Column:
    """A ticker, or five characters that end in 1 to 9 whole."""
    code = normalize_stock_code(c)
    return F.coalesce(source_code_to_ticker(c), F.when(code.rlike("^[0-9]{3}[0-9A-Z][1-9]$"), code))


#: The 33 sector names of the exchange in the order of their codes, and the one other spelling.
SECTORS = (
    "水産・農林業", "鉱業", "建設業", "食料品", "繊維製品", "パルプ・紙", "化学", "医薬品", "石油・石炭製品", "ゴム製品", "ガラス・土石製品",
    "鉄鋼", "非鉄金属", "金属製品", "機械", "電気機器", "輸送用機器", "精密機器", "その他製品", "電気・ガス業", "陸運業", "海運業",
    "空運業", "倉庫・運輸関連業", "情報・通信業", "卸売業", "小売業", "銀行業", "証券、商品先物取引業", "保険業", "その他金融業",
    "不動産業", "サービス業",
)
SECTOR_SPELLINGS = {"倉庫・運輸関連": "倉庫・運輸関連業"}


def normalize_sector(c: Column) -> Column:
    """A sector's name as the exchange has it; null for any other text."""
    name = F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    for other, own in SECTOR_SPELLINGS.items():
        name = F.when(name == other, own).otherwise(name)
    return F.when(name.isin(*SECTORS), name)


def is_sha256(c: Column) -> Column:
    return c.rlike("^[0-9a-f]{64}$")


def key_segment(c: Column, fallback: str = "_") -> Column:
    """One part of an object's key: what isn't safe as a hyphen, none at the ends; the fallback where nothing is left."""
    cleaned = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), "[^A-Za-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.when(cleaned == "", fallback).otherwise(cleaned)


def file_part(c: Column) -> Column:
    """One part of a file's name: as in a key, but hyphens at the ends stay."""
    cleaned = F.regexp_replace(F.trim(c), "[^A-Za-z0-9._-]+", "-")
    return F.when(cleaned == "", "unknown").otherwise(cleaned)


def _ending(ext: Column) -> Column:
    return F.regexp_replace(ext, "^[.]+", "")


def raw_key(source: Column, datatype: Column, scope: Column, date: Column, sha256: Column, ext: Column, doc_id: Column | None = None) -> Column:
    doc = key_segment(doc_id) if doc_id is not None else F.lit("_")
    name = F.concat(F.substring(sha256, 1, 16), F.lit("."), key_segment(F.lower(_ending(ext))))
    return F.concat_ws("/", F.lit("raw"), key_segment(F.lower(source)), key_segment(F.lower(datatype)), F.date_format(date, "yyyy"), F.date_format(date, "yyyy-MM-dd"), key_segment(scope), doc, name)


def derived_key(key: Column, suffix: Column) -> Column:
    """The key of what was made from a raw object; null for any other key."""
    base = F.regexp_replace(F.substring(key, 5, 1 << 20), "[.][^.]*$", "")
    return F.when(key.startswith("raw/"), F.concat(F.lit("derived/"), base, F.lit("."), key_segment(F.lower(_ending(suffix)))))


def supply_key(code: Column) -> Column:
    return F.concat(F.lit("supply/"), key_segment(code), F.lit(".json"))


def margin_key(date: Column) -> Column:
    return F.concat(F.lit("margin/"), F.date_format(date, "yyyy-MM-dd"), F.lit(".json"))


def raw_file_name(source: Column, datatype: Column, scope: Column, date: Column, ext: Column) -> Column:
    day = F.coalesce(F.date_format(date, "yyyyMMdd"), F.lit("nodate"))
    return F.concat(F.concat_ws("_", file_part(F.lower(source)), file_part(datatype), file_part(scope), day), F.lit("."), _ending(ext))


def converted_file_name(name: Column, ext: Column) -> Column:
    return F.concat(F.regexp_replace(name, "[.][^.]*$", ""), F.lit("_converted."), _ending(ext))
