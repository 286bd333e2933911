"""The visitor-log questions, composed from the operators."""
