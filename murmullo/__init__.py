"""murmullo: PySpark analytics for streams and tables of user comments.

Every operator is a plain ``DataFrame -> DataFrame`` or ``Column -> Column``
function. The same functions serve batch tables and Structured Streaming.
"""

__version__ = "0.1.0"
