"""Spark-native byte-pair encoding: corpus preparation, distributed training, encode and
decode as DataFrame operators, validation and tokenizer metrics."""

from .options import BPEOptions

__all__ = ["BPEOptions"]
__version__ = "0.1.0"
