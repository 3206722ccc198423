from .jobs import main

main()
