"""Training-data operators: packing, quality rules, language-model scoring,
near and exact de-duplication, decontamination, classifiers, sharding.

Nothing else in the library imports this subpackage.  ``queries()`` and
``oracle_sql()`` (module ``registry``) hold what the driver runs.
"""
