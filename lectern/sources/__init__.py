"""Tables, landed files and the derived transcript."""
