"""Training-data operators: language id, packing, de-duplication, tokenisation, PII,
HTML rendering, language-model scoring and vector search.

Nothing outside this subpackage imports it.  Every operator takes and returns DataFrames;
Python runs only in Arrow batches, and state that must outlive a task goes to the shared
folder named by ``spark.checkpoint.dir``.
"""
