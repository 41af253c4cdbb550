"""Scalar functions: native expressions where they are exact, Arrow UDFs where Python's text or JSON rules matter."""
