"""codexmill: document-structure analytics and corpus operators on PySpark.

Every operator takes and returns DataFrames. The plans are declarative, so the
optimizer chooses the physical strategy; Python (Arrow batches) appears only
where the built-in functions cannot express an operation, such as HTML
tokenising and Unicode normalisation.
"""

__version__ = "0.1.0"
