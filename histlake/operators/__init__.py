"""DataFrame -> DataFrame operators: ``keys``, ``scd``, ``snapshot``,
``summaries``, ``audit``, ``reference``, ``profile`` and ``joins``
(import the sub-modules directly)."""
