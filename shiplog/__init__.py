"""shiplog: change-set ledgers, layered configuration and enclosed table
transfer, expressed as Spark DataFrame jobs.

Layout
------
``functions``  Column expressions (parsing, predicates, text rendering).
``operators``  DataFrame -> DataFrame transforms (inventory, ledger, config,
               catalog, ordering, skew-safe numbering).
``sources``    Readers and writers (file-tree listing, config files, execution
               lists, column catalogs, enclosed-delimited export / load,
               ledger snapshots).
``plans``      End-to-end jobs built from the above, plus the relations the
               test tables are turned into.
``streaming``  Micro-batch ledger merge for continuously arriving inventories.
"""

__version__ = "0.1.0"
