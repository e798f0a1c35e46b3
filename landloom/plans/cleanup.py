"""Clean-up of raw object tables before any rule runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Spelling variants of placed-object tags.
TAG_SPELLING = {"art": {"Straße": "Strasse"}}


def normalised(df: DataFrame, blank: list[str] | None = None, spelling: dict[str, dict[str, str]] | None = None,
               zero: list[str] | None = None, flags: list[str] | None = None,
               markers: dict[str, list[str]] | None = None) -> DataFrame:
    """One projection: blanks and markers to null, spelling, zero counts to null, null flags to false."""
    blank, zero, flags = blank or [], zero or [], flags or []
    spelling, markers = spelling or {}, markers or {}

    def clean(name):
        c = F.col(name)
        if name in blank:
            c = F.nullif(c, F.lit(""))
        for bad, good in spelling.get(name, {}).items():
            c = F.when(c == bad, good).otherwise(c)
        if name in markers:
            c = F.when(~c.isin(*markers[name]), c)
        if name in zero:
            c = F.nullif(c, F.lit(0))
        if name in flags:
            c = F.coalesce(c, F.lit("false"))
        return c.alias(name)

    return df.select(*[clean(c) for c in df.columns])


def clean_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The clean-ups every derivation relies on."""
    out = dict(tables)
    for name in ("ap_ppo", "ap_lpo", "ap_pto", "ap_lto"):
        if name in out:
            out[name] = normalised(out[name], blank=["signaturnummer"],
                                   spelling=TAG_SPELLING if name == "ap_pto" else None)
    if "ax_gebaeude" in out:
        out["ax_gebaeude"] = normalised(
            out["ax_gebaeude"], zero=["anzahlderoberirdischengeschosse", "anzahlderunterirdischengeschosse"])
    if "ax_flurstueck" in out:
        out["ax_flurstueck"] = normalised(out["ax_flurstueck"], flags=["abweichenderrechtszustand"])
    if "ax_bodenschaetzung" in out:
        out["ax_bodenschaetzung"] = normalised(
            out["ax_bodenschaetzung"], markers={"bodenzahlodergruenlandgrundzahl": ["nicht belegt", ""]})
    return out
