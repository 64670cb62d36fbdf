"""A PySpark engine for multi-source measurement data, and operators for preparing training corpora."""

VERSION = "0.2.0"
