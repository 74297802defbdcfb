"""Language of each text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators import naive_bayes as nb

# Languages that short English mails are mistaken for, reported as English.
LANGUAGE_ALIASES = {"la": "en", "qu": "en"}


def fit_languages(examples: DataFrame, text: str, label: str) -> nb.NaiveBayes:
    """Train on texts of known language, with pairs of letters as features."""
    return nb.fit(examples, nb.letter_pairs(F.col(text)), label)


def alias_language(code: Column) -> Column:
    """Apply the alias table."""
    for source, target in LANGUAGE_ALIASES.items():
        code = F.when(code == source, target).otherwise(code)
    return code


def languages(docs: DataFrame, key: str, text: str, model: nb.NaiveBayes) -> DataFrame:
    """(key, language) for every row; the most likely language after aliases."""
    found = nb.classify(docs, key, nb.letter_pairs(F.col(text)), model, "language")
    return found.withColumn("language", alias_language(F.col("language")))
