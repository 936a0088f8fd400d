"""Clinical code lists and the predicates built on them."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code lists as published by the source guidance, print artefacts
# (stray spaces, trailing wildcards) included, because exact matching is on them.

ICD10_CONDITION = [
    "F00.0", "F00.1", "F00.2", "F00.9", "F01.0", "F01.1", "F01.2", "F01.3", "F01.8",
    "F01.9", "F02.0", "F02.1", "F02.2", "F02.3", "F02.4", "F02.8", "F03", "F05.1", "F000",
    "F001", "F002", "F009", "F010", "F011", "F012", "F013", "F018", "F019", "F020", "F021",
    "F022", "F023", "F024", "F028", "F051",
]

ICD10_DAGGER = ["G318", "G31.8"]

SNOMED_CONDITION = [
    "52448006", "15662003", "191449005", "191457008", "191461002", "231438001",
    "268612007", "45864009", "26929004", "416780008", "416975007", "4169750 07",
    "429998004", "230285003", "56267009", "230286002", "230287006", "230270009",
    "230273006", "90099008", "230280008", "86188000", "13092008", "21921000119103",
    "429458009", "442344002", "792004", "713060000", "425390006", "713844000",
    "191475009", "80098002", "312991009", "135811000119107", "13 5 8110 0 0119107",
    "42769004", "191519005", "281004", "191493005", "111480006", "1114 8 0 0 0 6",
    "32875003", "59651006", "278857002", "230269008", "79341000119107", "12348006",
    "421023003", "713488003", "191452002", "65096006", "31081000119101", "191455000",
    "1089501000000102", "10532003", "191454001", "230267005", "230268000", "230265002",
    "230266001", "191451009", "1914510 09", "22381000119105", "230288001", "191458003",
    "191459006", "191463004", "191464005", "191465006", "191466007", "279982005",
    "6475002", "66108005",
]

READ_V2_CONDITION = [
    "E00..%", "E0 0..%", "Eu01.%", "Eu 01.%", "Eu02.%", "Eu 02.%", "E012.%", "Eu00.%",
    "Eu 0 0.%", "F110.%", "A411.%", "A 411.%", "E02y1", "E041.", "E0 41.", "Eu041",
    "Eu 0 41", "F111.", "F112.", "F116.", "F118.", "F21y2", "A410.", "A 410.",
]

CTV3_CONDITION = ["XE1Xr%", "X002w%", "XE1Xs", "Xa0sE"]

MCI_CODES = ["F06.7", "F067", "386805003", "28E0.", "Xaagi"]

COHORT_PREFIXES = ["F03"]

# Codes looked for inside the joined diagnosis string of a spell.
CONDITION_IN_SPELL = [
    "F000", "F001", "F002", "F009", "F010", "F011", "F012", "F013", "F018", "F019", "F020",
    "F021", "F022", "F023", "F024", "F028", "F03", "F051",
]
MCI_IN_SPELL = ["F067"]
DELIRIUM_IN_SPELL = ["F050", "F058", "F059"]

COHORT_CODES = (
    ICD10_CONDITION + ICD10_DAGGER + SNOMED_CONDITION + READ_V2_CONDITION + CTV3_CONDITION + MCI_CODES
)


def contains_any(c: Column | str, codes: Sequence[str]) -> Column:
    """True when the text holds any code; one scan of the string, not one per code."""
    c = F.col(c) if isinstance(c, str) else c
    if len(codes) == 1:
        return c.contains(codes[0])
    return c.rlike("|".join(re.escape(code) for code in codes))


def flag_codes(c: Column | str, codes: Sequence[str]) -> Column:
    """1 when the text holds any code, else 0 (NULL text gives 0)."""
    return F.when(contains_any(c, codes), 1).otherwise(0)


def in_codes(
    c: Column | str,
    codes: Iterable[str],
    prefixes: Sequence[str] = (),
    wildcards: bool = False,
) -> Column:
    """Membership of a code list or one of a few prefixes.

    Listed codes match literally. With ``wildcards`` a listed code that ends in
    '%' counts as a prefix instead.
    """
    c = F.col(c) if isinstance(c, str) else c
    codes, prefixes = list(codes), list(prefixes)
    if wildcards:
        prefixes += [code[:-1] for code in codes if code.endswith("%")]
        codes = [code for code in codes if not code.endswith("%")]
    hit = c.isin(codes)
    for prefix in prefixes:
        hit = hit | c.startswith(prefix)
    return hit


def diagnosis_area(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(MCI_CODES), "MCI").otherwise("Condition")


def is_emergency(method: Column | str) -> Column:
    """Emergency admission methods are the codes that start with 2."""
    method = F.col(method) if isinstance(method, str) else method
    return method.startswith("2")
