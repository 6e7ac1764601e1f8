"""Scalar functions: Column -> Column, JVM-side only."""
