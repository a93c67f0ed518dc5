"""Corpus preparation operators for language-model training data.

Nothing outside this subpackage imports it.  Every operator takes DataFrames,
declares its plan and returns a DataFrame; intermediate results that must cut
lineage are written under the shared folder named by ``spark.checkpoint.dir``.
"""
