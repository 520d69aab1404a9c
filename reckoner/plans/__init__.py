"""The named analyses, composed from the operators."""
