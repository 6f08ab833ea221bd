"""shoplake: an online-shop lakehouse built from Spark DataFrames.

Layers: ``ods`` (ingested rows), ``dim`` (dimensions), ``dwd`` (enriched
facts), ``dws`` (aggregates), ``ads`` (report views) and ``reports``
(parameterised dashboard queries).  Every layer function takes and returns a
DataFrame, so the same code runs in a batch job and inside a streaming
micro-batch.
"""
