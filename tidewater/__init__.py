"""tidewater: a layered e-commerce warehouse (click logs and change logs in, fact tables
and windowed metric tables out) written as Spark DataFrame plans."""

__version__ = "0.1.0"
