"""textmill: a Spark-native engine for preparing, exploring, scoring and
evaluating large labelled text collections (e-mail style corpora).

Every operator is a plain function over ``DataFrame`` / ``Column`` objects so
Catalyst sees one declarative plan; nothing in the core collects rows to the
driver.
"""

__version__ = "0.1.0"
