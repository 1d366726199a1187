"""examflow: a PySpark engine for exam-paper documents, questions and corpora."""
