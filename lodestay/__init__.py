"""Listing-market analytics as Spark DataFrame jobs.

Layers, lowest first:

* ``functions``  Column builders (parsing, guards, row identity)
* ``sources``    dataset catalog, declared schemas, readers and sinks
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      the listing-market jobs composed from the operators
* ``suite``      the registered queries over the shared test tables
"""
