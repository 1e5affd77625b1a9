"""Readers and writers of the layers and serving tables."""

from paysieve.sources.jdbc import read_jdbc, write_jdbc
from paysieve.sources.landing import read_landing
from paysieve.sources.layers import layer_exists, layer_notes, read_layer, remove_unpublished, write_layer
from paysieve.sources.scratch import remove_scratch, scratch_path

__all__ = [
    "layer_exists",
    "layer_notes",
    "read_jdbc",
    "read_landing",
    "read_layer",
    "remove_scratch",
    "remove_unpublished",
    "scratch_path",
    "write_jdbc",
    "write_layer",
]
