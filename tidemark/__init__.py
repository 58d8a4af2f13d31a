"""tidemark: Spark operators over manifests, labels and transfer records of file-based datasets."""

__version__ = "0.1.0"
