"""limelight: attention-to-an-entity analytics as Spark DataFrame operators."""

__version__ = "0.1.0"
