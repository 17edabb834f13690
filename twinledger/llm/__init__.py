"""Operators of a training-data pipeline over tables of documents.

Each module holds one operator and works on any DataFrame with the columns it
names; `queries` binds them to the driver's tables. Rules that hold for all:

* a null text is an empty one, unless the operator says otherwise;
* rows with equal doc_id and equal text are one document seen twice and get the
  same result; a null doc_id is a value like any other;
* further columns are left alone, whatever their names;
* an empty table gives an empty result.
"""
