"""Presentation rules as data.

Conditions are written ``{"attribute": "codes"}``: codes are numbers or ranges
separated by blanks, ``null`` stands for a missing value, a leading ``!`` turns
the test round.  All conditions of a line must hold; the first line that holds
gives the style or text.  Style numbers, tags and texts are fixed values of the
signature catalogue.
"""

from __future__ import annotations

ANY: dict[str, str] = {}

# Theme per object type.
THEMES = {
    "Wohnbauflächen": ["ax_wohnbauflaeche"],
    "Industrie und Gewerbe": ["ax_industrieundgewerbeflaeche", "ax_halde", "ax_bergbaubetrieb", "ax_tagebaugrubesteinbruch",
                              "ax_flaechegemischternutzung", "ax_flaechebesondererfunktionalerpraegung",
                              "ax_vorratsbehaelterspeicherbauwerk", "ax_leitung"],
    "Sport und Freizeit": ["ax_sportfreizeitunderholungsflaeche"],
    "Friedhöfe": ["ax_friedhof"],
    "Verkehr": ["ax_strassenverkehr", "ax_weg", "ax_platz", "ax_bahnverkehr", "ax_flugverkehr", "ax_schiffsverkehr", "ax_gleis",
                "ax_bahnverkehrsanlage", "ax_flugverkehrsanlage", "ax_einrichtungenfuerdenschiffsverkehr"],
    "Vegetation": ["ax_landwirtschaft", "ax_wald", "ax_gehoelz", "ax_heide", "ax_moor", "ax_sumpf", "ax_unlandvegetationsloseflaeche"],
    "Gewässer": ["ax_fliessgewaesser", "ax_hafenbecken", "ax_stehendesgewaesser", "ax_meer", "ax_wasserspiegelhoehe"],
    "Gebäude": ["ax_gebaeude", "ax_turm"],
    "Flurstücke": ["ax_flurstueck"],
}

# Fill style per object type and code.
FILLS: dict[str, list[tuple[dict, int]]] = {
    "ax_flurstueck": [(ANY, 2028)],
    "ax_wohnbauflaeche": [(ANY, 25151401)],
    "ax_halde": [(ANY, 25151403)],
    "ax_bergbaubetrieb": [(ANY, 25151403)],
    "ax_tagebaugrubesteinbruch": [({"abbaugut": "4010"}, 25151404), (ANY, 25151403)],
    "ax_flaechegemischternutzung": [(ANY, 25151401)],
    "ax_flaechebesondererfunktionalerpraegung": [(ANY, 25151401)],
    "ax_sportfreizeitunderholungsflaeche": [(ANY, 25151405)],
    "ax_friedhof": [(ANY, 25151405)],
    "ax_strassenverkehr": [({"zustand": "4000"}, 25160000), ({"funktion": "2312 2313"}, 25151406), ({"funktion": "5130"}, 25151414),
                           (ANY, 25150000)],
    "ax_weg": [(ANY, 2515)],
    "ax_platz": [({"funktion": "5130"}, 25151414), (ANY, 2515)],
    "ax_bahnverkehr": [({"zustand": "4000"}, 25160000), ({"funktion": "2322"}, 25151406), (ANY, 25150000)],
    "ax_flugverkehr": [({"zustand": "4000"}, 2516), (ANY, 25151406)],
    "ax_schiffsverkehr": [({"zustand": "4000"}, 2516), (ANY, 2515)],
    "ax_landwirtschaft": [({"vegetationsmerkmal": "null 0 1010 1011 1012 1013"}, 25151409),
                          ({"vegetationsmerkmal": "1020 1021 1030 1031 1040 1050 1051 1052"}, 25151406),
                          ({"vegetationsmerkmal": "1200"}, 25151404)],
    "ax_wald": [(ANY, 25171414)],
    "ax_gehoelz": [(ANY, 25171414)],
    "ax_heide": [(ANY, 25171404)],
    "ax_moor": [(ANY, 25171404)],
    "ax_sumpf": [(ANY, 25171404)],
    "ax_unlandvegetationsloseflaeche": [({"funktion": "null 1000", "oberflaechenmaterial": "null 0 1010 1020 1030 1040"}, 2515),
                                        ({"funktion": "null 1000", "oberflaechenmaterial": "1110 1120"}, 2518),
                                        ({"funktion": "1100 1110 1120 1200"}, 25151406)],
    "ax_fliessgewaesser": [({"zustand": "4000"}, 2519), (ANY, 25181410)],
    "ax_hafenbecken": [(ANY, 25181410)],
    "ax_stehendesgewaesser": [({"hydrologischesmerkmal": "null"}, 25181410), ({"hydrologischesmerkmal": "2000"}, 25201410)],
    "ax_meer": [(ANY, 25181410)],
    "ax_vorratsbehaelterspeicherbauwerk": [({"lagezurerdoberflaeche": "null"}, 1305), ({"lagezurerdoberflaeche": "1200"}, 1321),
                                           ({"lagezurerdoberflaeche": "1400"}, 20311304)],
    "ax_bahnverkehrsanlage": [(ANY, 1541)],
    "ax_flugverkehrsanlage": [({"art": "1310 1320 1330 5531"}, 1808)],
    "ax_einrichtungenfuerdenschiffsverkehr": [(ANY, 1544)],
    "ax_turm": [({"zustand": "2200"}, 1502), (ANY, 1501)],
}

# Symbol style per object type, placed-object tag and code.
SYMBOLS: dict[tuple[str, str], list[tuple[dict, str]]] = {
    ("ax_industrieundgewerbeflaeche", "FKT"): [({"funktion": "1730"}, "3401"), ({"funktion": "2510"}, "3402"),
                                               ({"funktion": "2530 2432"}, "3403"), ({"funktion": "2540"}, "3404")],
    ("ax_bergbaubetrieb", "ZUS"): [({"zustand": "2100"}, "3406"), (ANY, "3505")],
    ("ax_tagebaugrubesteinbruch", "FKT"): [(ANY, "3407")],
    ("ax_sportfreizeitunderholungsflaeche", "FKT"): [
        ({"funktion": "4210 4211"}, "3410"), ({"funktion": "4220"}, "3411"), ({"funktion": "4330 4331"}, "3412"),
        ({"funktion": "4400 4410"}, "3413"), ({"funktion": "4420"}, "3415"), ({"funktion": "4430 4431"}, "3417"),
        ({"funktion": "4440"}, "3419"), ({"funktion": "4460"}, "3421"), ({"funktion": "4470"}, "3423")],
    ("ax_weg", "FKT"): [({"funktion": "5220 5230"}, "3424"), ({"funktion": "5240"}, "3426"), ({"funktion": "5250"}, "3428"),
                        ({"funktion": "5260"}, "3430")],
    ("ax_platz", "FKT"): [({"funktion": "5310"}, "3432"), ({"funktion": "5320"}, "3434"), ({"funktion": "5330"}, "3436")],
    ("ax_flugverkehr", "ART"): [({"funktion": "5530"}, "3438"), ({"funktion": "5550"}, "3439")],
    ("ax_landwirtschaft", "VEG"): [
        ({"vegetationsmerkmal": c}, s) for c, s in (
            ("1011", "3440"), ("1012", "3442"), ("1013", "3444"), ("1020", "3413"), ("1021", "3441"), ("1030", "3421"),
            ("1031", "3446"), ("1040", "3448"), ("1050", "3450"), ("1051", "3452"), ("1052", "3454"))],
    ("ax_wald", "VEG"): [({"vegetationsmerkmal": "null"}, "3456"), ({"vegetationsmerkmal": "1100"}, "3458"),
                         ({"vegetationsmerkmal": "1200"}, "3460"), ({"vegetationsmerkmal": "1300 1310 1320"}, "3462")],
    ("ax_gehoelz", "VEG"): [({"vegetationsmerkmal": "null"}, "3470"), ({"vegetationsmerkmal": "1400"}, "3472")],
    ("ax_heide", "Heide"): [(ANY, "3474")],
    ("ax_moor", "Moor"): [(ANY, "3476")],
    ("ax_sumpf", "Sumpf"): [(ANY, "3478")],
    ("ax_unlandvegetationsloseflaeche", "OFM"): [
        ({"funktion": "null 1000", "oberflaechenmaterial": c}, s) for c, s in (
            ("null", "3480"), ("1010", "3481"), ("1020", "3482"), ("1030", "3483"), ("1040", "3484"), ("1110 1120", "3486"))],
    ("ax_fliessgewaesser", "Fließpfeil"): [({"zustand": "!4000"}, "3488")],
    ("ax_fliessgewaesser", "FKT"): [({"funktion": "8300", "zustand": "4000"}, "3490")],
    ("ax_hafenbecken", "FKT"): [(ANY, "3490")],
    ("ax_stehendesgewaesser", "FKT"): [(ANY, "3490")],
    ("ax_meer", "FKT"): [(ANY, "3490")],
    ("ax_vorratsbehaelterspeicherbauwerk", "Vorratsbehaelter"): [({"_dim": "1 3"}, "3522")],
    ("ax_flugverkehrsanlage", "ART"): [({"_dim": "1", "art": "1410"}, "3589"), ({"_dim": "1", "art": "1420"}, "3590"),
                                       ({"_dim": "1", "art": "1430"}, "3556"), ({"art": "5531"}, "3588")],
    ("ax_einrichtungenfuerdenschiffsverkehr", "ART"): [
        ({"_dim": "1", "art": c}, s) for c, s in (("1420", "3590"), ("1430", "3556"), ("1440", "3583"), ("1450", "3584"), ("9999", "3640"))],
    ("ax_wasserspiegelhoehe", "SYMBOL"): [({"hoehedeswasserspiegels": "!null"}, "3623")],
    ("ax_gebaeude", "GFK"): [
        ({"gebaeudefunktion": c}, s) for c, s in (
            ("2030", "3300"), ("2056", "3338"), ("2071", "3302"), ("2072", "3303"), ("2081", "3305"), ("2092", "3306"),
            ("2094", "3308"), ("2461 2462", "3309"), ("2465", "3336"), ("2523", "3521"), ("2612", "3311"), ("3013", "3312"),
            ("3032", "3314"), ("3037", "3315"), ("3041", "3316"), ("3042", "3317"), ("3043", "3318"), ("3046", "3319"),
            ("3047", "3320"), ("3051 3052", "3321"), ("3065", "3323"), ("3071", "3324"), ("3072", "3326"), ("3094", "3328"),
            ("3095", "3330"), ("3097", "3332"), ("3221", "3334"), ("3290", "3340"))],
}

# Symbols drawn only where a placed symbol exists.
PLACED_SYMBOLS = [("ax_fliessgewaesser", "Fließpfeil"), ("ax_flugverkehrsanlage", "ART")]

# Label tag, default style, and where the text comes from.
# text: attribute; enum: (domain, attribute, text before, text after); catalogue: street catalogue name;
# constant: texts by code; missing: text when the catalogue has no entry; placed: only with a placed text;
# when: objects the label is for; unless: not beside a placed text of this tag; enum_when: objects whose
# text comes from the enumeration; styles: default styles by code, before ``style``.
LABELS: dict[tuple[str, str], dict] = {
    ("ax_wohnbauflaeche", "NAM"): {"style": "4141", "text": "name"},
    ("ax_industrieundgewerbeflaeche", "NAM"): {"style": "4141", "text": "name"},
    ("ax_halde", "Halde_LGT"): {"style": "4140", "enum": ("ax_lagergut_halde", "lagergut", "Halde\n(", ")"), "constant": [(ANY, "Halde")]},
    ("ax_halde", "NAM"): {"style": "4141", "text": "name"},
    ("ax_bergbaubetrieb", "AGT"): {"style": "4141", "enum": ("ax_abbaugut_bergbaubetrieb", "abbaugut", "(", ")")},
    ("ax_bergbaubetrieb", "NAM"): {"style": "4141", "text": "name"},
    ("ax_tagebaugrubesteinbruch", "AGT"): {
        "style": "4141", "when": {"abbaugut": "!null"}, "enum": ("ax_abbaugut_tagebaugrubesteinbruch", "abbaugut", "(", ")"),
        "constant": [({"abbaugut": "4100"}, "(Torfstich)")]},
    ("ax_tagebaugrubesteinbruch", "NAM"): {"style": "4141", "text": "name"},
    ("ax_flaechegemischternutzung", "NAM"): {"style": "4141", "text": "name"},
    ("ax_flaechebesondererfunktionalerpraegung", "NAM"): {"style": "4141", "text": "name"},
    ("ax_flaechebesondererfunktionalerpraegung", "FKT"): {
        "style": "4070", "placed": True, "enum": ("ax_funktion_flaechebesondererfunktionalerpraegung", "funktion", "", "")},
    ("ax_sportfreizeitunderholungsflaeche", "FKT"): {
        "style": "4140", "when": {"name": "null"}, "unless": "NAM",
        "enum": ("ax_funktion_sportfreizeitunderholungsflaeche", "funktion", "", ""),
        "enum_when": {"funktion": "4110 4200 4230 4240 4250 4260 4270 4280 4290 4310 4450"},
        "constant": [({"funktion": "4100 4101"}, "Sportanlage"), ({"funktion": "4300 4301"}, "Erholungsfläche"), ({"funktion": "4320 4321"}, "Bad")]},
    ("ax_sportfreizeitunderholungsflaeche", "NAM"): {"style": "4141", "text": "name"},
    ("ax_friedhof", "NAM"): {"style": "4141", "text": "name"},
    ("ax_strassenverkehr", "ZNM"): {"style": "4141", "text": "zweitname"},
    ("ax_strassenverkehr", "FKT"): {"style": "4100", "when": {"funktion": "4130"}, "enum": ("ax_funktion_strasse", "funktion", "", "")},
    ("ax_bahnverkehr", "ZNM"): {"style": "4141", "text": "zweitname"},
    ("ax_flugverkehr", "NAM"): {"style": "4200", "text": "unverschluesselt", "catalogue": True},
    ("ax_landwirtschaft", "NAM"): {"style": "4208", "text": "name"},
    ("ax_wald", "NAM"): {"style": "4209", "text": "name"},
    ("ax_gehoelz", "NAM"): {"style": "4209", "text": "name"},
    ("ax_heide", "NAM"): {"style": "4209", "text": "name"},
    ("ax_moor", "NAM"): {"style": "4209", "text": "name"},
    ("ax_sumpf", "NAM"): {"style": "4209", "text": "name"},
    ("ax_gleis", "NAM"): {"style": "4107", "text": "name"},
    ("ax_unlandvegetationsloseflaeche", "NAM"): {"style": "4150", "styles": [({"oberflaechenmaterial": "1110 1120"}, "4151")], "text": "name"},
    ("ax_hafenbecken", "NAM"): {"style": "4211", "text": "unverschluesselt", "catalogue": True},
    ("ax_meer", "NAM"): {"style": "4286", "text": "unverschluesselt", "catalogue": True},
    ("ax_vorratsbehaelterspeicherbauwerk", "NAM"): {"style": "4107", "text": "name"},
    ("ax_leitung", "BWF"): {"style": "4070", "constant": [({"bauwerksfunktion": "1111"}, "Erdkabel")]},
    ("ax_flugverkehrsanlage", "NAM"): {"style": "4107", "text": "name"},
    ("ax_einrichtungenfuerdenschiffsverkehr", "KMA"): {"style": "4101", "text": "kilometerangabe"},
    ("ax_einrichtungenfuerdenschiffsverkehr", "NAM"): {"style": "4081", "text": "name"},
    ("ax_turm", "NAM"): {"style": "4074", "text": "name"},
    ("ax_wasserspiegelhoehe", "HWS"): {"style": "4102", "text": "hoehedeswasserspiegels"},
}
# Place names shown where a placed text of the tag exists.
PLACE_LABELS = {"Gewanne": "4206"}
for _tag, _style in PLACE_LABELS.items():
    LABELS[("ax_lagebezeichnungohnehausnummer", _tag)] = {
        "style": _style, "placed": True, "text": "unverschluesselt", "catalogue": True,
        "missing": ("(Lagebezeichnung zu '", "' fehlt)"), "theme": "Lagebezeichnungen"}

# Line style per object type and code.
LINES: dict[str, list[tuple[dict, int]]] = {
    "ax_gleis": [({"lagezuroberflaeche": "null"}, 2525), ({"lagezuroberflaeche": "1200"}, 2300), ({"lagezuroberflaeche": "1400"}, 2301)],
    "ax_leitung": [({"bauwerksfunktion": "1110"}, 2524), ({"bauwerksfunktion": "1111"}, 2523)],
}

# Symbol spacing along tracks in millimetres and symbol, by track category.
TRACK_SPACING = [((1201, 1300, 1302), 16000), ((1301,), 8000), ((1600,), 20000)]
TRACK_SYMBOLS = [((1201,), "3646"), ((1300, 1301), "3647"), ((1302,), "3648"), ((1600,), "3649")]

# Line style per border code set, highest rank first.
BORDER_STYLES = [("2016", (7101,)), ("2018", (7102,)), ("2020", (7103,)), ("2026", (7108,)), ("2010", (2500, 7104)),
                 ("2022", (7106,)), ("2024", (7107,)), ("2014", (7003,)), ("2012", (3000,))]

# Buildings. Class by function, then fill by class and edge by state.
BUILDING_CLASSES = [("1000-1999", 1301), ("2000-2999", 1304), ("3000-3999", 1309), ("9998", 1304)]
RUIN_STATES = "2200 2300 3000 4000"


def building_fills() -> list[tuple[dict, int]]:
    """Fill styles of buildings: edge number followed by the fill number of the class.

    Standing above ground 2505, on stilts 2031, high-rise 2623 and 2030; ruins
    keep only the edge; below ground 2032.  Open construction (4000) of the
    classes 2000 and 3000 takes the stilts edge.
    """
    above, stilts, below = {"lagezurerdoberflaeche": "null 0"}, {"lagezurerdoberflaeche": "1400"}, {"lagezurerdoberflaeche": "1200"}
    high, low = {"hochhaus": "1"}, {"hochhaus": "!1"}
    ruin, whole = {"zustand": RUIN_STATES}, {"zustand": "!" + RUIN_STATES}
    standing = {"lagezurerdoberflaeche": "null 0 1400"}
    out: list[tuple[dict, int]] = []
    for codes, fill in BUILDING_CLASSES:
        use = {"gebaeudefunktion": codes}
        both = lambda edge: edge * 10000 + fill
        if codes in ("2000-2999", "3000-3999"):
            out.append(({**use, **low, **whole, **above, "bauweise": "4000"}, both(2031)))
        out += [({**use, **low, **whole, **above}, both(2505)), ({**use, **high, **whole, **above}, both(2623)),
                ({**use, **high, **ruin, **standing}, 2030), ({**use, **high, **whole, **stilts}, both(2030))]
        if codes != "2000-2999":  # ruins of this class have no low variant
            out.append(({**use, **low, **ruin, **standing}, 2031))
        out += [({**use, **low, **whole, **stilts}, both(2031)), ({**use, **low, **below}, 2032)]
    return out


FILLS["ax_gebaeude"] = building_fills()


def theme_of(source: str) -> str | None:
    return next((t for t, names in THEMES.items() if source in names), None)
