"""Topic readers and the test-table topic views."""
