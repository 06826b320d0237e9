"""Deterministic identifiers of the standardised maintenance model."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Concept name -> identifier prefix.
CONCEPT_PREFIXES = {
    "ProductInstance": "PI",
    "FunctionalFailure": "FF",
    "MaintenanceTask": "MT",
    "MaintenanceTaskStep": "MTS",
    "MaintenanceEvent": "ME",
}
HASH_CHARS = 12


def concept_prefix(concept: str) -> str:
    return CONCEPT_PREFIXES.get(concept, concept[:3].upper())


def concept_id(concept: str, source_id: Column | str, null_id: str = "hash") -> Column:
    """``<prefix>-<first 12 hex digits of sha256("<concept>:<source id>")>``.

    A null source id hashes as the text ``None``, so all missing references share one identifier;
    ``null_id="null"`` gives null instead.
    """
    key = F.col(source_id) if isinstance(source_id, str) else source_id

    def identify(known: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(f"{concept}:"), known), 256)
        return F.concat(F.lit(f"{concept_prefix(concept)}-"), F.substring(digest, 1, HASH_CHARS))

    if null_id == "null":
        return identify(key)
    if null_id != "hash":
        raise ValueError("null_id must be 'hash' or 'null'")
    # never null, and saying so spares joins on identifiers a null check that would hash again
    return F.coalesce(identify(F.coalesce(key, F.lit("None"))), F.lit(""))
