"""Controlled vocabularies: levels, cycles, subjects and what a file name tells."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Levels and their cycles, in school order.
LEVELS = {
    "sixieme": "cycle3",
    "cinquieme": "cycle4",
    "quatrieme": "cycle4",
    "troisieme": "cycle4",
    "seconde": "lycee",
    "premiere": "lycee",
    "terminale": "lycee",
}

#: Subjects and their labels.
SUBJECTS = {
    "mathematiques": "Mathématiques",
    "francais": "Français",
    "histoire_geo": "Histoire-Géographie",
    "physique_chimie": "Physique-Chimie",
    "svt": "Sciences de la Vie et de la Terre",
    "emc": "Enseignement Moral et Civique",
    "technologie": "Technologie",
    "sciences_technologie": "Sciences et Technologie",
    "arts_plastiques": "Arts plastiques",
    "education_musicale": "Éducation musicale",
    "histoire_des_arts": "Histoire des arts",
    "eps": "Éducation physique et sportive",
    "anglais": "Anglais",
    "espagnol": "Espagnol",
    "allemand": "Allemand",
    "italien": "Italien",
    "langues_vivantes": "Langues vivantes",
    "snt": "Sciences Numériques et Technologie",
    "enseignement_scientifique": "Enseignement Scientifique",
    "philosophie": "Philosophie",
    "ses": "Sciences Économiques et Sociales",
    "nsi": "Numérique et Sciences Informatiques",
    "hggsp": "Histoire-Géographie, Géopolitique et Sciences Politiques",
    "hlp": "Humanités, Littérature et Philosophie",
}

#: What stands in a file name, tried in this order, and the levels it means.
FILE_LEVELS = {
    "_cycle4_": ["cinquieme", "quatrieme", "troisieme"],
    "_cycle3_": ["sixieme"],
    "_college_": ["sixieme", "cinquieme", "quatrieme", "troisieme"],
    "_lycee_": ["seconde", "premiere", "terminale"],
}


def looked_up(values: dict[str, str], key: Column) -> Column:
    """The value of a key in a small fixed vocabulary, null where it has none."""
    return F.create_map(*map(F.lit, chain.from_iterable(values.items())))[key]


def cycle_of(level: Column, strict: bool = False) -> Column:
    """The cycle of a level; null, or an error if ``strict``, for an unknown one."""
    found = looked_up(LEVELS, level)
    return F.coalesce(found, F.raise_error(F.concat(F.lit("unknown level: "), F.coalesce(level, F.lit("null"))))) if strict else found


def label_of(subject: Column) -> Column:
    """The label of a subject; the subject itself where it is in no vocabulary."""
    return F.coalesce(looked_up(SUBJECTS, subject), subject)


def levels_of_file(source_file: Column, strict: bool = False) -> Column:
    """The levels a file name means, as an array; null, or an error if ``strict``, where it names none."""
    out = None
    for mark, levels in FILE_LEVELS.items():
        test, value = F.lower(source_file).contains(mark), F.array(*map(F.lit, levels))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out.otherwise(F.raise_error(F.concat(F.lit("no levels in file name: "), source_file))) if strict else out
