"""Training-data operators: ten corpus operators written for Spark.

Each module holds one operator with a general interface; ``queries``
registers the thin ``opN_<name>`` queries over the test tables, and
``oracle`` states those that SQL can express.  Nothing outside this
package imports it.
"""
