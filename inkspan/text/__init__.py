"""Text functions: Column to Column, evaluated in the JVM."""
