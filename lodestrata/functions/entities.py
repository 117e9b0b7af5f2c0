"""Entities of a text by rule: runs of words between punctuation and stop words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that never belong to an entity.
STOP_WORDS = (
    "a about above after again against all also although am an and any are as at be because been before being below between both but by can could "
    "did do does doing down during each few for from further had has have having he her here hers him his how i if in into is it its itself may me might "
    "more most must my no nor not of off on once one only or other our ours out over own same she should since so some such than that the their theirs "
    "them then there these they this those through to too under until up us very was we were what when where which while who whom why will with within without would you your"
).split()
STOP = rf"(?i)(?<![\p{{L}}\p{{N}}'-])(?:{'|'.join(STOP_WORDS)})(?![\p{{L}}\p{{N}}'-])"
MIN_LENGTH = 4


def entities(text: Column) -> Column:
    """Distinct phrases in order of appearance, lower case, longer than three characters and with a letter in them."""
    cut = F.split(F.regexp_replace(F.lower(text), STOP, "|"), r"[^\p{L}\p{N} '-]+")
    phrases = F.transform(cut, lambda x: F.trim(F.regexp_replace(x, r" +", " ")))
    return F.array_distinct(F.filter(phrases, lambda x: (F.length(x) >= MIN_LENGTH) & x.rlike(r"\p{L}")))
