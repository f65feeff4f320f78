"""A Spark-first engine for curating question/answer pools and training corpora."""
