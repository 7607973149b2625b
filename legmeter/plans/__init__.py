"""One module per business line, plus finishing, export and the job runner."""
