"""Deterministic identities: name-based UUIDs (version 5) as JVM expressions, and content hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The DNS namespace of RFC 4122, and the namespace under which case names become project ids.
DNS = "6ba7b810-9dad-11d1-80b4-00c04fd430c8"
CASES = "6a97cb34-226e-5c31-8fab-345c8fca2399"
UUID_FORM = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z"


def _from_bytes(namespace: Column, name: Column) -> Column:
    h = F.sha1(F.concat(F.unhex(F.replace(namespace, F.lit("-"), F.lit(""))), F.encode(name, "UTF-8")))
    nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), nibble % 4 + 1)
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def uuid5(namespace: Column | str, name: Column) -> Column:
    """The version 5 UUID of name; a namespace that is no UUID counts as the UUID of its text under DNS."""
    if isinstance(namespace, str):
        import uuid

        try:
            fixed = str(uuid.UUID(namespace))
        except ValueError:
            fixed = str(uuid.uuid5(uuid.UUID(DNS), namespace))
        return _from_bytes(F.lit(fixed), name)
    return _from_bytes(F.when(namespace.rlike(UUID_FORM), F.lower(namespace)).otherwise(_from_bytes(F.lit(DNS), namespace)), name)


def project_id(case_name: Column) -> Column:
    return _from_bytes(F.lit(CASES), case_name)


def document_id(project: Column, file_name: Column) -> Column:
    """From the file's name with its extension."""
    return _from_bytes(project, F.concat(F.lit("document::"), file_name))


def chunk_id(document: Column, start: Column, end: Column) -> Column:
    """From the chunk's offsets; offsets that are no span raise an error."""
    bad = (start < 0) | (end <= start)
    span = F.concat(start.cast("string"), F.lit(":"), end.cast("string"))
    return F.when(bad, F.raise_error(F.concat(F.lit("not a span: "), span))).otherwise(_from_bytes(document, span))


def entity_id(project: Column, entity_type: Column, normalized: Column) -> Column:
    return _from_bytes(project, F.concat(F.lit("entity::"), entity_type, F.lit("::"), normalized))


def content_hash(content: Column) -> Column:
    """Hex SHA-256 of bytes; null for null."""
    return F.sha2(content, 256)
