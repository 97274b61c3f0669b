"""cohortlink: a Spark-native release pipeline for processed imaging series.

One lazy DataFrame plan takes a whole cohort from plain tables (cohort, scan
catalogue, nested container metadata, file listing, registry of earlier
uploads) to a package manifest, a submission record, an outcome ledger, an
issues table and a summary.  Every public function is DataFrame -> DataFrame
or Column -> Column; data problems become rows of ``issues``, never raised
exceptions.
"""

__version__ = "0.1.0"
