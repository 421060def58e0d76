"""Operators of a training-data pipeline.

Nothing else in the library imports this package: removing the folder (together with
``corpus_pipeline.py``) leaves the rest of the library working.

Conventions shared by all operators
* An operator selects the columns it names (``id_col``, ``text_col``) into private frames
  first, so extra columns of the input, whatever their names, neither clash nor get lost by
  accident; the filters of ``corpus_pipeline.py`` return the input's own columns.
* A null text is an empty text, a null id is an ordinary value (joins on ids are null-safe).
* Intermediates that several branches read are written under ``spark.checkpoint.dir``
  (:func:`freshcat.llm.common.stage`); that also cuts the lineage for lost executors.
* Two sides that both grow with the data are joined with a ``merge`` hint: the plan is then
  the same at every size, and skewed partitions are still split by adaptive execution. Sides
  with a proven or counted bound are broadcast.
"""
