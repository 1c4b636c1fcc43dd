"""blobtally: space accounting for blob stores that pack small blobs into large files.

Everything is a Spark DataFrame plan:

* ``sources``   - typed readers for the object table, blob index, file index, file lengths,
                  and the two job outputs (file status, file meta); fixture tables derived from testdata.
* ``functions`` - column expressions (byte decoding, archive test, run-path layout, region buckets).
* ``operators`` - reference resolution, per-file status and meta, split packing, relocation,
                  key-value cells.
* ``plans``     - the two jobs (aggregate, compact), sinks, and the query catalogue.
"""

from blobtally.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
