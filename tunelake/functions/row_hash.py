"""MD5 of a raw record, to find copies of the same record.

The hashed text is the record as a JSON object with sorted keys, ``", "`` and ``": "`` as separators
and all characters beyond ASCII escaped, so the digest can be recomputed outside Spark. These are SQL
expressions rather than columns, as a record has many fields.
"""

from __future__ import annotations

from collections.abc import Mapping


def json_text(value: str) -> str:
    """A text value as a JSON string, or ``null``."""
    # Written as the only element of an array, whose brackets are then taken off; text ends in a quote.
    return f"substring(trim(TRAILING ']' FROM to_json(array({value}))), 2)"


def record_text(fields: Mapping[str, str]) -> str:
    """JSON object of ``{name: JSON text}``; a field whose JSON text is null is absent from it."""
    members = ", ".join(f"concat('\"{name}\": ', {fields[name]})" for name in sorted(fields))
    return f"concat('{{', concat_ws(', ', {members}), '}}')"


def _hex4(code: str) -> str:
    return f"concat('\\\\u', lower(lpad(hex({code}), 4, '0')))"


def ascii_only(text: str) -> str:
    """Every character beyond ASCII as a ``\\uXXXX`` escape (two for those beyond the basic plane).

    ``text`` is a column name. Text that is plain already skips the work per character.
    """
    high, low = "55296 + (ascii(c) - 65536) div 1024", "56320 + (ascii(c) - 65536) % 1024"
    escaped = (
        f"CASE WHEN ascii(c) < 128 THEN c WHEN ascii(c) < 65536 THEN {_hex4('ascii(c)')} "
        f"ELSE concat({_hex4(high)}, {_hex4(low)}) END"
    )
    return (
        f"CASE WHEN {text} RLIKE '[^\\\\x00-\\\\x7F]' "
        f"THEN array_join(transform(split({text}, ''), c -> {escaped}), '') ELSE {text} END"
    )


def row_hash(record: str) -> str:
    """MD5 of a record text held in a column."""
    return f"md5({ascii_only(record)})"
