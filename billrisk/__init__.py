"""Late-payment analytics for instalment bills, written for Spark.

Sub-packages
------------
``sources``    readers and writers (bill files, payment ledger, calendar, scores, models)
``functions``  column expressions (dates, flags, buckets, codes)
``operators``  DataFrame -> DataFrame building blocks (clean, label, join, profile, features, evaluate)
``plans``      end-to-end jobs composed from the operators
"""

__version__ = "0.1.0"
