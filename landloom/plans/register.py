"""Register book: flat marts from open object rows.

Every function takes object tables as DataFrames and returns one mart.  Keys
are computed once per table (``with_keys``) and joins run on link tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import arrays as A, fractions as FR, geometry as G, text as T
from ..operators import links, lookups, shares, spatial
from ..session import stored

CELL = 64.0

# Land-use types: class id, detail column, text between, type text, enumeration.
LAND_USE = [
    ("ax_bahnverkehr", "42010", "funktion", ", ", "Bahnverkehr", "ax_funktion_bahnverkehr"),
    ("ax_bergbaubetrieb", "41004", "abbaugut", " von ", "Bergbaubetrieb", "ax_abbaugut_bergbaubetrieb"),
    ("ax_flaechebesondererfunktionalerpraegung", "41007", "funktion", ", ", "Fläche besonderer funktionaler Prägung",
     "ax_funktion_flaechebesondererfunktionalerpraegung"),
    ("ax_flaechegemischternutzung", "41006", "funktion", ", ", "Fläche gemischter Nutzung", "ax_funktion_flaechegemischternutzung"),
    ("ax_fliessgewaesser", "44001", "funktion", ", ", "Fließgewässer", "ax_funktion_fliessgewaesser"),
    ("ax_flugverkehr", "42015", "funktion", ", ", "Flugverkehr", "ax_funktion_flugverkehr"),
    ("ax_friedhof", "41009", "funktion", ", ", "Friedhof", "ax_funktion_friedhof"),
    ("ax_gehoelz", "43003", "funktion", ", ", "Gehölz", "ax_funktion_gehoelz"),
    ("ax_hafenbecken", "44005", "funktion", ", ", "Hafenbecken", "ax_funktion_hafenbecken"),
    ("ax_halde", "41003", "lagergut", ", ", "Halde", "ax_lagergut_halde"),
    ("ax_heide", "43004", None, "", "Heide", None),
    ("ax_industrieundgewerbeflaeche", "41002", "funktion", ", ", "Industrie- und Gewerbefläche", "ax_funktion_industrieundgewerbeflaeche"),
    ("ax_landwirtschaft", "43001", "vegetationsmerkmal", ", ", "Landwirtschaft", "ax_vegetationsmerkmal_landwirtschaft"),
    ("ax_meer", "44007", "funktion", ", ", "Meer", "ax_funktion_meer"),
    ("ax_moor", "43005", None, "", "Moor", None),
    ("ax_platz", "42009", "funktion", ", ", "Platz", "ax_funktion_platz"),
    ("ax_schiffsverkehr", "42016", "funktion", ", ", "Schiffsverkehr", "ax_funktion_schiffsverkehr"),
    ("ax_sportfreizeitunderholungsflaeche", "41008", "funktion", ", ", "Sport-, Freizeit- und Erholungsfläche",
     "ax_funktion_sportfreizeitunderholungsflaeche"),
    ("ax_stehendesgewaesser", "44006", "funktion", ", ", "Stehendes Gewässer", "ax_funktion_stehendesgewaesser"),
    ("ax_strassenverkehr", "42001", "funktion", ", ", "Straßenverkehr", "ax_funktion_strasse"),
    ("ax_sumpf", "43006", None, "", "Sumpf", None),
    ("ax_tagebaugrubesteinbruch", "41005", "abbaugut", " von ", "Tagebau, Grube, Steinbruch", "ax_abbaugut_tagebaugrubesteinbruch"),
    ("ax_unlandvegetationsloseflaeche", "43007", "funktion", ", ", "Unland, vegetationslose Fläche",
     "ax_funktion_unlandvegetationsloseflaeche"),
    ("ax_wald", "43002", "vegetationsmerkmal", ", ", "Wald", "ax_vegetationsmerkmal_wald"),
    ("ax_weg", "42006", "funktion", ", ", "Weg", "ax_funktion_weg"),
    ("ax_wohnbauflaeche", "41001", "artderbebauung", " mit Art der Bebauung ", "Wohnbaufläche", "ax_artderbebauung_wohnbauflaeche"),
]
# Classifications: class id, prefix, code column, soil and field number columns, enumeration.
CLASSIFICATIONS = [
    ("ax_bodenschaetzung", "72001", "b", "nutzungsart", "bodenzahlodergruenlandgrundzahl", "ackerzahlodergruenlandzahl",
     "ax_nutzungsart_bodenschaetzung"),
    ("ax_bewertung", "72004", "B", "klassifizierung", None, None, "ax_klassifizierung_bewertung"),
    ("ax_klassifizierungnachwasserrecht", "71003", "W", "artderfestlegung", None, None,
     "ax_artderfestlegung_klassifizierungnachwasserrecht"),
    ("ax_klassifizierungnachstrassenrecht", "71001", "S", "artderfestlegung", None, None,
     "ax_artderfestlegung_klassifizierungnachstrassenrecht"),
]
# Sources of executing authorities; the first two are protected areas joined to their zones.
AUTHORITY_ZONES = ["ax_schutzgebietnachwasserrecht", "ax_schutzgebietnachnaturumweltoderbodenschutzrecht"]
AUTHORITY_TABLES = [
    "ax_naturumweltoderbodenschutzrecht", "ax_forstrecht", "ax_bauraumoderbodenordnungsrecht",
    "ax_klassifizierungnachstrassenrecht", "ax_denkmalschutzrecht", "ax_anderefestlegungnachwasserrecht",
    "ax_anderefestlegungnachstrassenrecht", "ax_sonstigesrecht", "ax_klassifizierungnachwasserrecht"]
FICTITIOUS_SHEET = "5000"
ENCUMBRANCE = 2610
STREET_GAP = "    "


def commune(prefix: str = "gemeindezugehoerigkeit_") -> Column:
    return T.municipality_key(prefix + "land", prefix + "regierungsbezirk", prefix + "kreis", prefix + "gemeinde")


def with_keys(parcels: DataFrame) -> DataFrame:
    """Open parcels with their key, district key and municipality key as columns."""
    return links.open_rows(parcels).withColumns({
        "flsnr": T.parcel_key(), "flsnrk": T.parcel_number(), "gemashl": T.district_key("land", "gemarkungsnummer"), "gemshl": commune()})


def sheet_number(alias: str = "") -> Column:
    return T.sheet_key(alias + "land", alias + "bezirk", alias + "buchungsblattnummermitbuchstabenerweiterung")


# -- parcels --------------------------------------------------------------

def flurst(parcels: DataFrame, places: DataFrame) -> DataFrame:
    """One row per parcel key: areas, coordinate text, keys, joined place names."""
    p = lookups.earliest_wins(with_keys(parcels), ["flsnr"])
    named = links.open_rows(places).groupBy(F.col("gml_id").alias("target")).agg(A.joined_set("unverschluesselt", "\n").alias("lagebez"))
    pointing = links.link_table(p, "zeigtauf", "target", ["ogc_fid"])
    joined = links.link_join(named, pointing, "target").groupBy("ogc_fid").agg(A.joined_set("lagebez", "\n").alias("lagebez"))
    at = G.point_on_surface("wkb_geometry")["parts"][0][0]
    return p.join(joined, "ogc_fid", "left").select(
        "flsnr", "flsnrk", "gemashl", T.pad_number(F.coalesce("flurnummer", F.lit(0)), 3).alias("flr"),
        F.concat(T.pad_number(F.year("zeitpunktderentstehung"), 4), F.lit("/     -  ")).alias("entst"),
        T.half_even_int("amtlicheflaeche").alias("flsfl"), F.col("amtlicheflaeche").alias("amtlflsfl"),
        G.area("wkb_geometry").alias("gemflsfl"), T.coordinate_text(at["x"], at["y"]).alias("flskoord"), "gemshl", "lagebez")


def encumbrance_sheets(parcels: DataFrame, rights: DataFrame, cell: float = CELL) -> DataFrame:
    """Sheet numbers of encumbrances lying on a parcel, joined and capped."""
    p = with_keys(parcels).select("flsnr", F.col("wkb_geometry").alias("_pg"))
    r = links.open_rows(rights).filter(F.col("artderfestlegung") == ENCUMBRANCE).select("bezeichnung", F.col("wkb_geometry").alias("_rg"))
    hits = spatial.overlay(p, r, "_pg", "_rg", cell).select("flsnr", "bezeichnung").distinct()
    return hits.groupBy("flsnr").agg(A.joined_set("bezeichnung").alias("_b")).select("flsnr", T.capped_list("_b").alias("blbnr"))


def with_encumbrances(parcels_mart: DataFrame, sheets: DataFrame) -> DataFrame:
    return parcels_mart.join(sheets, "flsnr", "left")


# -- streets --------------------------------------------------------------

def street_keys(catalogue: DataFrame) -> DataFrame:
    """Street keys from the catalogue: earliest entry per trimmed key, history mark cut."""
    c = links.open_rows(catalogue).withColumn("_k", F.trim("schluesselgesamt"))
    c = lookups.earliest_wins(c, ["_k"])
    key = T.municipality_key("land", "regierungsbezirk", "kreis", "gemeinde")
    return c.select(F.concat(key, F.lit(STREET_GAP), F.trim("lage")).alias("strshl"),
                    F.regexp_replace("bezeichnung", " H$", "").alias("strname"), key.alias("gemshl")).filter("strshl IS NOT NULL").distinct()


def uncoded_streets(addresses: DataFrame, parcels: DataFrame) -> DataFrame:
    """Addresses without a street key with their parcel, municipality and name."""
    l = links.open_rows(addresses).filter("lage IS NULL AND unverschluesselt IS NOT NULL").select("gml_id", F.col("unverschluesselt").alias("strname"), "hausnummer")
    pointing = links.link_table(with_keys(parcels).select("flsnr", "gemshl", "weistauf"), "weistauf", "gml_id")
    return links.link_join(l, pointing, "gml_id")


def synthetic_street_keys(streets: DataFrame, addresses: DataFrame, parcels: DataFrame) -> DataFrame:
    """Keys for names the catalogue does not know: numbered per municipality after the known ones."""
    new = uncoded_streets(addresses, parcels).select("gemshl", "strname").filter("gemshl IS NOT NULL").distinct()
    new = lookups.missing_keys(new, streets, ["gemshl", "strname"])
    have = streets.groupBy("gemshl").agg(F.count(F.lit(1)).alias("_have"))
    out = lookups.numbered(new.join(have, "gemshl", "left"), ["gemshl"], ["strname"], "_no", F.coalesce("_have", F.lit(0)))
    return out.select(F.concat("gemshl", F.lit("   -"), F.col("_no").cast("string")).alias("strshl"), "strname", "gemshl")


def parcel_streets(parcels: DataFrame, numbered: DataFrame, plain: DataFrame, streets: DataFrame) -> DataFrame:
    """Parcel to street: coded with number, uncoded with number, coded without number."""
    p = with_keys(parcels).select("flsnr", "gemshl", "weistauf", "zeigtauf")
    key = F.concat(T.municipality_key("land", "regierungsbezirk", "kreis", "gemeinde"), F.lit(STREET_GAP), F.trim("lage"))
    coded = links.open_rows(numbered).filter("lage IS NOT NULL").select("gml_id", key.alias("strshl"), F.col("hausnummer").alias("hausnr"))
    by_number = links.link_join(coded, links.link_table(p, "weistauf", "gml_id", ["flsnr"]), "gml_id")
    names = lookups.any_value(streets, ["gemshl", "strname"], "strshl")
    by_name = uncoded_streets(numbered, parcels).join(names, ["gemshl", "strname"], "left").withColumnRenamed("hausnummer", "hausnr")
    bare = links.open_rows(plain).filter("lage IS NOT NULL").select("gml_id", key.alias("strshl"), F.lit("").alias("hausnr"))
    by_place = links.link_join(bare, links.link_table(p, "zeigtauf", "gml_id", ["flsnr"]), "gml_id")
    cols = ["flsnr", "strshl", "hausnr"]
    return by_number.select(cols).unionByName(by_name.select(cols)).unionByName(by_place.select(cols))


def with_hex_key(df: DataFrame, order: list[str], out: str = "pk") -> DataFrame:
    """Running number in hex over the natural key."""
    return lookups.global_number(df, order, "_rn").withColumn(out, T.hex_key("_rn")).drop("_rn")


# -- ownership ------------------------------------------------------------

def open_sheets(sheets: DataFrame) -> DataFrame:
    return links.open_rows(sheets).select(F.col("gml_id").alias("istbestandteilvon"), sheet_number().alias("bestdnr"), "blattart")


#: Neighbouring numbers of listed places that are counted up in one window.
COUNT_TOGETHER = 1024


def ownership(parcels: DataFrame, bookings: DataFrame, sheets: DataFrame, reduce: bool = False) -> DataFrame:
    """Shares of every parcel in every sheet along chained bookings.

    Bookings on fictitious sheets pass their shares on but are not listed.
    Bookings reached by a reference take part even when they have ended.
    ``anteil`` is cut for display; ``zaehler`` and ``nenner`` hold all digits.

    What hangs below a booking does not depend on the parcel: it is walked and
    added up once per booking of a parcel, then again for the keys that hold
    several parcels.  The list of a holding (a booking, or such a key) is stored;
    the rows of the parcels are made from it when they are read.  Their running
    number ``bvnr`` is worked out where that column is read.
    """
    at_sheet = bookings.join(open_sheets(sheets), "istbestandteilvon")
    place = ["bestdnr", "laufendenummer", "buchungsart"]
    shown = F.col("blattart") != FICTITIOUS_SHEET
    places = lookups.global_number(at_sheet.filter(shown).select(*place).distinct(), place, "_e")
    # numbers follow the order of a sheet's list: the first one of its line, the first one of the sheet
    first_of = lambda *by: F.min("_e").over(Window.partitionBy(*by))
    places = stored(places.withColumn("_line", first_of("bestdnr", "laufendenummer")).withColumn("_sheet", first_of("bestdnr")), "places")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place]
    numbers = places.select("_e", *[F.col(c).alias(f"_{c}") for c in place])
    at_sheet = stored(at_sheet.join(numbers, [shown, *same], "left").select(
        "gml_id", "an", "zaehler", "nenner", F.col("endet").isNull().alias("_open"), "_e"), "booked")

    parts = int(parcels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = stored(with_keys(parcels).filter("istgebucht IS NOT NULL").groupBy("flsnr", "istgebucht").agg(F.count(F.lit(1)).alias("_m")), "pairs")
    holds = pairs.groupBy("flsnr").agg(F.count(F.lit(1)).alias("_k"), F.sum("_m").alias("_m"), F.min("istgebucht").alias("_b"))
    alone = (F.col("_k") == 1) & (F.col("_m") == 1)
    # a holding: 0 and the booking of the key's only parcel, or 1 and the key, or 2 for parcels without a key
    holds = holds.select("flsnr", F.when(alone, 0).when(F.col("flsnr").isNull(), 2).otherwise(1).alias("_kind"),
                         F.when(alone, F.col("_b")).otherwise(F.coalesce("flsnr", F.lit(""))).alias("_who"))
    holds = stored(holds.repartitionByRange(parts, "flsnr").withColumn("_piece", F.spark_partition_id()), "holdings")

    first = at_sheet.filter("_open").select(F.col("gml_id").alias("_root"), F.col("gml_id").alias("booking"), "zaehler", "nenner", "_e")
    roots = lookups.present_keys(first, pairs.select(F.col("istgebucht").alias("_root")), ["_root"])
    onward = links.link_table(at_sheet.drop("_open"), "an", "refers").withColumnRenamed("gml_id", "booking")
    walked = shares.walk(roots, onward, "booking", "refers", "zaehler", "nenner")
    limbs = stored(FR.limb_sums(walked.filter("_e IS NOT NULL"), ["_root", "_e"], "zaehler", "nenner"), "shares")

    single = holds.filter("_kind = 0").select("_kind", "_who", F.col("_who").alias("_root")).distinct()
    several = holds.filter("_kind > 0").select(F.col("flsnr").alias("_f"), "_kind", "_who")
    members = pairs.join(several, F.col("flsnr").eqNullSafe(F.col("_f"))).select("_kind", "_who", F.col("istgebucht").alias("_root"), "_m")
    summed = limbs.join(members, "_root").groupBy("_kind", "_who", "_e", "_d", "_i").agg(
        F.sum(F.col("_p") * F.col("_m").cast("decimal(20,0)")).cast(FR.NUM).alias("_p"))
    keys = ["_kind", "_who", "_e"]
    listed = stored(FR.fold_limbs(limbs.join(single, "_root").select(*keys, "_d", "_i", "_p").unionByName(summed), keys, "anteil", reduce), "shares")

    own = listed.join(places, "_e")
    rows = holds.join(own, ["_kind", "_who"])
    within = F.row_number().over(Window.partitionBy("_piece", "_line").orderBy("flsnr", "buchungsart"))
    out = rows.withColumn("_within", within).join(_rows_before(holds, own), ["_piece", "_line"], "left")
    return out.select("flsnr", "bestdnr", T.pad_number(F.col("_before") + F.col("_within"), 4).alias("bvnr"), F.col("buchungsart").alias("b"),
                      T.truncate_dots("anteil", 24).alias("anteil"), F.col("laufendenummer").alias("auftlnr"),
                      F.col("anteil_parts.n").alias("zaehler"), F.col("anteil_parts.d").alias("nenner"))


def _rows_before(holds: DataFrame, own: DataFrame) -> DataFrame:
    """Rows of a sheet's list before those of each line and piece of parcel keys: one row per ``_piece, _line``.

    Counted from the lists of the holdings, without making the rows.
    """
    each = own.groupBy("_kind", "_who", "_line", "_sheet").agg(F.count(F.lit(1)).alias("_n"))
    times = holds.groupBy("_piece", "_kind", "_who").agg(F.count(F.lit(1)).alias("_t"))
    count = times.join(each, ["_kind", "_who"]).groupBy("_piece", "_line", "_sheet").agg(F.sum(F.col("_n") * F.col("_t")).alias("_n"))
    count = count.withColumn("_part", F.floor(F.col("_line") / COUNT_TOGETHER))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = count.withColumn("_in", before(Window.partitionBy("_part").orderBy("_line", "_piece")))
    ahead = count.groupBy("_part").agg(F.sum("_n").alias("_n")).select("_part", before(Window.partitionBy(F.lit(0)).orderBy("_part")).alias("_ahead"))
    every = inside.join(ahead, "_part").withColumn("_at", F.col("_in") + F.col("_ahead"))
    starts = every.groupBy("_sheet").agg(F.min("_at").alias("_start"))
    return every.join(starts, "_sheet").groupBy("_piece", "_line").agg(F.min(F.col("_at") - F.col("_start")).alias("_before"))


def sheet_remarks(bookings: DataFrame, sheets: DataFrame) -> DataFrame:
    b = links.open_rows(bookings).filter("beschreibungdessondereigentums IS NOT NULL")
    return b.join(open_sheets(sheets), "istbestandteilvon").select(
        "bestdnr", F.col("laufendenummer").alias("lnr"), F.col("beschreibungdessondereigentums").alias("text"))


def bestand(sheets: DataFrame) -> DataFrame:
    """Sheets: earliest per trimmed key, no fictitious ones."""
    s = links.open_rows(sheets).filter(F.col("blattart") != FICTITIOUS_SHEET)
    s = s.withColumn("_no", F.trim("buchungsblattnummermitbuchstabenerweiterung"))
    every = links.open_rows(sheets).withColumn("_no", F.trim("buchungsblattnummermitbuchstabenerweiterung"))
    first = every.groupBy("land", "bezirk", "_no").agg(F.min("beginnt").alias("_first"))
    kept = s.join(first, ["land", "bezirk", "_no"]).filter(F.col("beginnt") <= F.col("_first"))
    return kept.select(sheet_number().alias("bestdnr"), T.pad_number(T.safe_int("bezirk"), 4).alias("gbbz"),
                       F.col("buchungsblattnummermitbuchstabenerweiterung").alias("gbblnr"))


def owners(name_numbers: DataFrame, sheets: DataFrame, persons: DataFrame, addresses: DataFrame, enums: DataFrame) -> DataFrame:
    """Owner lines: composed names and addresses per name number and address."""
    nn = links.open_rows(name_numbers).join(open_sheets(sheets).select("istbestandteilvon", "bestdnr"), "istbestandteilvon")
    p = links.open_rows(persons).select(F.col("gml_id").alias("benennt"), *[F.col(c) for c in (
        "nachnameoderfirma", "vorname", "geburtsname", "geburtsdatum", "namensbestandteil", "akademischergrad", "anrede", "hat")])
    nn = nn.join(p, "benennt", "left").withColumn("_a", F.explode_outer("hat"))
    a = links.open_rows(addresses).select(F.col("gml_id").alias("_a"), "strasse", F.col("hausnummer").alias("_hn"), "postleitzahlpostzustellung", "ort_post", "bestimmungsland")
    # a person without any matching address keeps one line
    out = nn.join(a.withColumn("_hit", F.lit(True)), "_a", "left").withColumn("_no_hit", F.col("_hit").isNull())
    matched = out.filter("NOT _no_hit")
    unmatched = out.filter("_no_hit").drop("_a").dropDuplicates(["gml_id"]).join(
        matched.select("gml_id").distinct(), "gml_id", "left_anti").withColumn("_a", F.lit(None).cast("string"))
    out = matched.unionByName(unmatched)
    out = lookups.label_lookup(out, enums, "ax_artderrechtsgemeinschaft_namensnummer", "artderrechtsgemeinschaft", "_art")
    out = lookups.label_lookup(out, enums, "ax_anrede_person", "anrede", "_anrede")
    opt = lambda before, c, after="": F.coalesce(F.concat(F.lit(before), F.col(c), F.lit(after)), F.lit(""))
    person = F.concat("nachnameoderfirma", opt(", ", "vorname"))
    group = F.concat(F.coalesce("_art", F.lit("Verschiedene")), opt(": ", "beschriebderrechtsgemeinschaft"))
    street = F.concat("strasse", opt(" ", "_hn"))
    cut = lambda c, n=200: T.truncate_dots(c, n)
    return out.select(
        "bestdnr", F.col("laufendenummernachdin1421").alias("namensnr"),
        F.concat(F.col("zaehler").cast("string"), F.lit("/"), F.col("nenner").cast("string")).alias("antverh"),
        F.substring(F.coalesce("nachnameoderfirma", T.bracketed("_art")), 1, 4).alias("name"),
        T.squeeze_spaces(cut(F.coalesce(person, group))).alias("name1"),
        cut(F.concat(opt("geb. ", "geburtsname", ", "), F.lit("* "), F.col("geburtsdatum"))).alias("name2"),
        cut(street).alias("name3"), cut(F.concat(opt("", "postleitzahlpostzustellung", " "), F.col("ort_post"))).alias("name4"),
        cut("bestimmungsland").alias("name5"), F.col("_anrede").alias("anrede"), cut("vorname").alias("vorname"),
        cut("nachnameoderfirma").alias("nachname"), cut("namensbestandteil").alias("namensteile"), cut("akademischergrad").alias("ak_grade"),
        cut("geburtsname").alias("geb_name"), F.col("geburtsdatum").alias("geb_datum"), street.alias("str_hnr"),
        cut("postleitzahlpostzustellung", 20).alias("plz"), cut("ort_post").alias("ort"), cut("bestimmungsland", 100).alias("land"))


def sheet_areas(sheets_mart: DataFrame, parcels_mart: DataFrame, ownership_mart: DataFrame) -> DataFrame:
    """Sheet area from the shares in official parcel areas; the integer only within its range."""
    sums = shares.weighted_area(ownership_mart.select("flsnr", "bestdnr", "zaehler", "nenner"), ["bestdnr"], "amtlflsfl", "zaehler", "nenner",
                                "amtlbestfl", parcels_mart.select("flsnr", "amtlflsfl"), "flsnr")
    return sheets_mart.join(sums, "bestdnr", "left").withColumn(
        "bestfl", F.when(F.col("amtlbestfl") <= 2147483647, T.half_even_int("amtlbestfl")))


# -- overlays -------------------------------------------------------------

def land_use_areas(tables: dict[str, DataFrame]) -> DataFrame:
    """Land-use areas of all types with nothing below them."""
    config = {name: (i, cls, field) for i, (name, cls, field, *_) in enumerate(LAND_USE)}

    def shape(name, df):
        i, cls, field = config[name]
        detail = F.col(field).cast("string") if field else F.lit(None).cast("string")
        return links.open_rows(df).filter("hatdirektunten IS NULL").select(
            (F.col("ogc_fid") * 32 + i).alias("ogc_fid"), F.lit(name).alias("name"), "gml_id", F.lit(int(cls)).alias("kennung"),
            F.concat(F.lit(cls), F.coalesce(F.concat(F.lit(":"), detail), F.lit(""))).alias("nutzung"), "wkb_geometry")

    return lookups.unify({n: t for n, t in tables.items() if n in config}, shape)


def classification_areas(tables: dict[str, DataFrame]) -> DataFrame:
    config = {row[0]: (i, *row[1:]) for i, row in enumerate(CLASSIFICATIONS)}

    def shape(name, df):
        i, cls, prefix, field, soil, acre, _ = config[name]
        text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
        return links.open_rows(df).select(
            (F.col("ogc_fid") * 4 + i).alias("ogc_fid"), F.lit(name).alias("name"), "gml_id", F.lit(int(cls)).alias("kennung"),
            F.concat(F.lit(prefix + ":"), text(field)).alias("klassifizierung"), text(soil).alias("bodenzahl"), text(acre).alias("ackerzahl"), "wkb_geometry")

    return lookups.unify({n: t for n, t in tables.items() if n in config}, shape)


def _overlaid(parcels: DataFrame, areas: DataFrame, by: list[str], cell: float) -> DataFrame:
    p = with_keys(parcels).select("flsnr", "ogc_fid", "amtlicheflaeche", F.col("wkb_geometry").alias("_pg"), G.area("wkb_geometry").alias("_pa"))
    a = areas.select(*by, F.col("wkb_geometry").alias("_ag"))
    pairs = spatial.overlay(p, a, "_pg", "_ag", cell).select("flsnr", "ogc_fid", "amtlicheflaeche", "_pa", *by, "common")
    out = pairs.groupBy("flsnr", "ogc_fid", *by).agg(F.sum("common").alias("gemfl"), F.min("amtlicheflaeche").alias("_o"), F.min("_pa").alias("_pa"))
    scaled = F.col("gemfl") * F.col("_o") / F.nullif(F.col("_pa"), F.lit(0.0))
    return out.select("flsnr", *by, "gemfl", T.half_even_int(scaled).alias("fl"))


def land_use(parcels: DataFrame, tables: dict[str, DataFrame], cell: float = CELL) -> DataFrame:
    """Land use per parcel: common area and the same scaled to the official area."""
    return _overlaid(parcels, land_use_areas(tables), ["nutzung"], cell).withColumnRenamed("nutzung", "nutzsl")


def classifications(parcels: DataFrame, tables: dict[str, DataFrame], cell: float = CELL) -> DataFrame:
    out = _overlaid(parcels, classification_areas(tables), ["klassifizierung", "bodenzahl", "ackerzahl"], cell)
    return out.withColumnsRenamed({"klassifizierung": "klf", "bodenzahl": "wertz1", "ackerzahl": "wertz2"})


def authority_areas(tables: dict[str, DataFrame]) -> DataFrame:
    """Areas with an executing authority, protected areas by their zones."""
    found = {}
    zones = links.link_table(links.open_rows(tables["ax_schutzzone"]).select("gml_id", "istteilvon", "hatdirektunten", "wkb_geometry"), "istteilvon", "_area") \
        if "ax_schutzzone" in tables else None
    for name in AUTHORITY_ZONES:
        if name in tables and zones is not None:
            area = links.open_rows(tables[name]).select(F.col("gml_id").alias("_area"), "land", "stelle")
            found["v_" + name[3:]] = links.link_join(area, zones, "_area").withColumn("endet", F.lit(None).cast("string"))
    found |= {n: tables[n] for n in AUTHORITY_TABLES if n in tables}

    def shape(name, df):
        return links.open_rows(df).filter("hatdirektunten IS NULL").select(
            F.lit(name).alias("name"), "gml_id", F.concat(T.pad_number(T.safe_int("land"), 2), F.col("stelle")).alias("ausf_st"), "wkb_geometry")

    return lookups.unify(found, shape)


def authorities(parcels: DataFrame, tables: dict[str, DataFrame], cell: float = CELL) -> DataFrame:
    p = with_keys(parcels).select("flsnr", F.col("wkb_geometry").alias("_pg"))
    a = authority_areas(tables).select("ausf_st", F.col("wkb_geometry").alias("_ag"))
    return spatial.overlay(p, a, "_pg", "_ag", cell).select("flsnr", "ausf_st").distinct()


def authority_keys(authorities_mart: DataFrame, offices: DataFrame) -> DataFrame:
    used = authorities_mart.select(F.col("ausf_st").alias("schluesselgesamt")).distinct()
    return offices.join(used, "schluesselgesamt", "left_semi").groupBy(F.col("schluesselgesamt").alias("ausf_st")).agg(F.min("bezeichnung").alias("afst_txt"))


# -- keys and links -------------------------------------------------------

def predecessors(historic: DataFrame) -> DataFrame:
    """Successor and predecessor keys of historic parcels."""
    return links.open_rows(historic).select(F.explode("nachfolgerflurstueckskennzeichen").alias("_s"), "flurstueckskennzeichen").select(
        T.code_to_key("_s").alias("flsnr"), T.code_to_key("flurstueckskennzeichen").alias("v_flsnr"))


def _completed(known: DataFrame, used: DataFrame, key: str, name: str, word: str) -> DataFrame:
    """Known keys plus a placeholder for every used key without a name."""
    gone = lookups.missing_keys(used.filter(F.col(key).isNotNull()).distinct(), known, [key])
    return known.unionByName(gone.select(key, F.concat(F.lit(f"({word} "), F.col(key), F.lit(")")).alias(name)))


def district_keys(districts: DataFrame, parcels: DataFrame, sheets: DataFrame, parcels_mart: DataFrame, sheets_mart: DataFrame) -> DataFrame:
    """District keys in use with name and municipality."""
    known = links.open_rows(districts).groupBy(T.district_key("land", "gemarkungsnummer").alias("gemashl")).agg(F.min("bezeichnung").alias("gemarkung"))
    live = parcels_mart.select("gemashl").union(sheets_mart.select(F.substring("bestdnr", 1, 6))).distinct()
    known = lookups.present_keys(known, live, ["gemashl"])
    used = parcels.select(F.substring("flurstueckskennzeichen", 1, 6).alias("gemashl")).union(sheets.select(T.district_key("land", "bezirk")))
    back = lookups.any_value(parcels_mart, ["gemashl"], "gemshl")
    return _completed(known, used, "gemashl", "gemarkung", "Gemarkung").join(back, "gemashl", "left")


def municipality_keys(municipalities: DataFrame, parcels: DataFrame, districts_mart: DataFrame, streets_mart: DataFrame, parcels_mart: DataFrame) -> DataFrame:
    """Municipality keys in use."""
    known = links.open_rows(municipalities).groupBy(T.pad_number(T.safe_int("schluesselgesamt"), 8).alias("gemshl")).agg(F.min("bezeichnung").alias("gemname"))
    used = parcels.select(T.municipality_key("land", *[f"gemeindezugehoerigkeit_{c}" for c in ("regierungsbezirk", "kreis", "gemeinde")]).alias("gemshl"))
    full = _completed(known, used, "gemshl", "gemname", "Gemeinde")
    live = districts_mart.select("gemshl").union(streets_mart.select("gemshl")).union(parcels_mart.select("gemshl")).distinct()
    return lookups.present_keys(full, live, ["gemshl"])


def used_streets(streets: DataFrame, assignments: DataFrame) -> DataFrame:
    """Street keys some parcel uses; the history mark goes once more for one state."""
    kept = lookups.present_keys(streets, assignments, ["strshl"])
    name = F.when(F.col("strshl").startswith("07"), F.trim(F.regexp_replace("strname", " H$", ""))).otherwise(F.col("strname"))
    return kept.withColumn("strname", name)


def ownership_kinds(enums: DataFrame) -> DataFrame:
    return enums.filter("domain = 'ax_buchungsart_buchungsstelle'").select(F.col("code").alias("b"), F.substring("label", 1, 60).alias("eignerart"))


def run_stamp(spark) -> DataFrame:
    text = F.concat(F.lit("Aus ALKIS übernommen: "), F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return spark.range(1).select(F.lit(1).alias("ffnr"), text.alias("beschreibung"))


def object_keys(parcels: DataFrame) -> DataFrame:
    return with_keys(parcels).select(F.col("ogc_fid").alias("fs_key"), F.col("gml_id").alias("fs_obj"), F.col("flsnr").alias("alb_key"))


def use_keys(enums: DataFrame) -> DataFrame:
    """Land-use keys: every type, and every type with each detail code."""
    spark = enums.sparkSession
    conf = F.broadcast(spark.createDataFrame([(c, t + r, e) for _, c, _, r, t, e in LAND_USE if e], "cls string, before string, domain string"))
    types = spark.createDataFrame([(c, t) for _, c, _, _, t, _ in LAND_USE], "nutzshl string, nutzung string")
    detail = enums.join(conf, "domain").select(F.concat_ws(":", "cls", "code").alias("nutzshl"), F.concat("before", "label").alias("nutzung"))
    return types.unionByName(detail).distinct()


def class_keys(enums: DataFrame) -> DataFrame:
    conf = F.broadcast(enums.sparkSession.createDataFrame([(p, e) for _, _, p, _, _, _, e in CLASSIFICATIONS], "prefix string, domain string"))
    return enums.join(conf, "domain").select(F.concat_ws(":", "prefix", "code").alias("klf"), F.col("label").alias("klf_text")).distinct()


# -- views and totals -----------------------------------------------------

def owner_view(parcels_mart: DataFrame, assignments: DataFrame, streets: DataFrame, ownership_mart: DataFrame, owners_mart: DataFrame) -> DataFrame:
    """Addresses, sheets and owners of each parcel as joined text."""
    named = assignments.join(streets.select("strshl", "strname"), "strshl", "left")
    addresses = named.groupBy("flsnr").agg(A.joined_set(F.trim(F.concat_ws(" ", "strname", "hausnr")), "\n").alias("adressen"))
    # owners are joined per sheet first, so a sheet is never multiplied by its parcels and owners at once
    per_sheet = owners_mart.groupBy("bestdnr").agg(A.joined_set("name1", "\n").alias("_o"))
    held = ownership_mart.select("flsnr", "bestdnr").distinct().join(per_sheet, "bestdnr", "left")
    text = held.groupBy("flsnr").agg(A.joined_set("bestdnr", "\n").alias("bestaende"), A.joined_set("_o", "\n").alias("eigentuemer"))
    return parcels_mart.select("flsnr").join(addresses, "flsnr", "left").join(text, "flsnr", "left")


def house_points(buildings: DataFrame, addresses: DataFrame, streets: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Building centroid with number, street and municipality."""
    key = T.municipality_key("land", "regierungsbezirk", "kreis", "gemeinde")
    a = links.open_rows(addresses).select("gml_id", "hausnummer", key.alias("gemshl"), F.concat(key, F.lit(STREET_GAP), F.trim("lage")).alias("strshl"))
    b = links.link_table(links.open_rows(buildings).select(F.col("ogc_fid").alias("gebaeude"), "zeigtauf", "wkb_geometry"), "zeigtauf", "gml_id")
    out = links.link_join(a, b, "gml_id").join(streets.select("strshl", "strname"), "strshl", "left").join(
        municipalities.select("gemshl", "gemname"), "gemshl", "left").withColumn("_c", G.centroid("wkb_geometry"))
    at = F.col("_c")["parts"][0][0]
    return out.select("gebaeude", at["x"].alias("x"), at["y"].alias("y"), "hausnummer", "strname", "gemname")


def totals(sheets_mart: DataFrame, parcels_mart: DataFrame, ownership_mart: DataFrame, owners_mart: DataFrame) -> DataFrame:
    """Register totals and orphans."""
    def one(o, name, df):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(o).alias("o"), F.lit(name).alias("buchdaten"), "n")

    gone = lookups.missing_keys
    return (one(1, "Bestände", sheets_mart)
            .unionByName(one(2, "Bestände ohne Eigentümerart", gone(sheets_mart, ownership_mart, ["bestdnr"])))
            .unionByName(one(3, "Bestände ohne Eigentümer", gone(sheets_mart, owners_mart, ["bestdnr"])))
            .unionByName(one(4, "Flurstücke", parcels_mart))
            .unionByName(one(5, "Flurstücke ohne Eigentümerart", gone(parcels_mart, ownership_mart, ["flsnr"])))).orderBy("o")
