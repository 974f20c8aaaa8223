"""gildmill: Spark jobs that turn messy tables into clean, enriched, searchable ones.

Layers, each a plain function over public PySpark types:

* ``functions``  Column -> Column expressions (text, parsing, nested list text)
* ``operators``  DataFrame -> DataFrame operators (filters, dedup, joins, search)
* ``sources``    readers, writers and the batch document sink
* ``plans``      the composed jobs: bronze to silver, silver to gold, gold to documents
* ``queries``    bindings of every operator to the test tables, with SQL oracles
"""
