"""Operations for large text corpora that feed language-model training.

Each module holds one operator with a general interface and one ``query``
function of the signature ``(spark, sf_dir) -> DataFrame`` that applies it to a
whole table. ``registry`` collects the queries and their SQL.
"""
