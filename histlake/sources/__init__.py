"""Readers and writers: explicit-schema Parquet in, typed appends and laid-out
(clustered) tables out."""

from histlake.sources.readers import (file_inventory, read_batch,  # noqa: F401
                                      read_stream, read_table, with_file_name)
from histlake.sources.writers import (append_typed, materialize,  # noqa: F401
                                      write_bucketed, write_clustered)
